"""Multi-step jobs: build the layers, report on a corpus, train and score classifiers."""

"""Stop-word lists for n-gram counting."""

from __future__ import annotations

from collections.abc import Sequence

# Function words in the form in which the tokeniser leaves them: two letters or more and no
# apostrophe, so that "don't" is listed as its pieces.
_ARTICLES = "an the this that these those"
_PRONOUNS = (
    "he she it we you they me him her us them my your his its our their mine yours hers ours theirs "
    "myself yourself himself herself itself ourselves themselves who whom whose which what"
)
_VERBS = (
    "am is are was were be been being do does did doing done have has had having can could may might "
    "must shall should will would ain aren couldn didn doesn don hadn hasn haven isn mustn shouldn wasn "
    "weren won wouldn ll re ve"
)
_PREPOSITIONS = (
    "about above across after against along among around as at before behind below beside between "
    "beyond by down during for from in inside into near of off on onto out over since through to "
    "toward under until up upon with within without"
)
_JOINING = "and or but nor so yet if because although though while whereas unless than then when where why how whether"
_COUNTING = "all any both each either every few more most much many neither none no not only other some such same own"
_ADVERBS = "again also almost already always ever here there just never now often once quite rather still too very"

ENGLISH = tuple(sorted(set(" ".join([_ARTICLES, _PRONOUNS, _VERBS, _PREPOSITIONS, _JOINING, _COUNTING, _ADVERBS]).split())))


def resolve_stop_words(stop_words: str | Sequence[str] | None) -> list[str]:
    """``"english"`` is the list of this module; a sequence is used as given; None keeps every word."""
    if stop_words is None:
        return []
    if stop_words == "english":
        return list(ENGLISH)
    if isinstance(stop_words, str):
        raise ValueError(f"no stop-word list {stop_words!r}; pass the words")
    return list(stop_words)

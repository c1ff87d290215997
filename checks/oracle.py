"""DuckDB SQL with the expected result of each query in ``checks.queries``.

The SQL is written independently of the Spark plans: plain GROUP BY, window and quantile
functions, no histograms, hash ranges or fitted objects.
"""

from __future__ import annotations

from checks.queries import (
    DESCRIBED,
    ISSUE_IDS,
    ISSUE_NAMES,
    MATRIX_COLUMNS,
    METRIC_IDS,
    OWN_STOP_WORDS,
)
from reviewmill.functions.stopwords import ENGLISH
from reviewmill.operators.bootstrap import STEPS
from reviewmill.operators.quality import ACTIONS
from reviewmill.schema import LABELS, NUMERIC_FEATURES, REVIEW_COLUMNS
from reviewmill.plans.reports import RANGE_METRICS
from reviewmill.sources.driver_tables import ODDITIES

TEXT_COLUMNS = ("Year_Month", "Reviewer_Location", "Review_Text", "Branch")

PLAIN_REVIEWS = """reviews AS (
  SELECT r.doc_id*2 + r.copy AS row_id, r.doc_id AS Review_ID,
    CAST(CASE WHEN lang='en' THEN CASE WHEN doc_id % 3 = 0 THEN 4 ELSE 5 END
         WHEN lang='es' THEN CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 2 END
         ELSE 3 END AS INTEGER) AS Rating,
    CASE WHEN doc_id % 16 = 0 THEN 'missing'
         ELSE concat(CAST(CAST(2010 + floor((doc_id % 120)/12) AS INT) AS VARCHAR),'-',
                     CAST(1 + (doc_id % 12) AS VARCHAR)) END AS Year_Month,
    source AS Reviewer_Location, text AS Review_Text,
    CASE WHEN doc_id % 9 < 4 THEN 'park_a' WHEN doc_id % 9 < 7 THEN 'park_b' ELSE 'park_c' END AS Branch
  FROM (SELECT *, 0 AS copy FROM documents
        UNION ALL SELECT *, 1 AS copy FROM documents WHERE doc_id % 50 = 0) r)"""



def _odd(name: str) -> str:
    """The column of an odd row."""
    cases = " ".join(
        f"WHEN {kind} THEN " + ("NULL" if value is None else str(value) if isinstance(value, int) else "'" + value + "'")
        for kind, (column, value) in enumerate(ODDITIES)
        if column == name
    )
    return f"CASE CAST(floor(Review_ID/40) AS INTEGER) % {len(ODDITIES)} {cases} ELSE {name} END AS {name}" if cases else name


REVIEWS = PLAIN_REVIEWS.replace("reviews AS (", "plain_reviews AS (", 1) + f""",
reviews AS (SELECT * FROM plain_reviews UNION ALL
  SELECT -1 - Review_ID AS row_id, {", ".join(_odd(c) for c in REVIEW_COLUMNS)} FROM plain_reviews
  WHERE Review_ID % 40 = 7 AND row_id % 2 = 0)"""

THREE_CLASS = "CASE WHEN Rating IN (1,2) THEN 'negative' WHEN Rating=3 THEN 'neutral' WHEN Rating IN (4,5) THEN 'positive' END"
BINARY = "CASE WHEN Rating IN (1,2,3) THEN 'negative' WHEN Rating IN (4,5) THEN 'positive' END"
MONTH = "CAST(CASE WHEN regexp_full_match(Year_Month,'[0-9]{4}-[0-9]{1,2}') THEN try_strptime(Year_Month,'%Y-%m') END AS DATE)"

LABELLED = f"labelled AS (SELECT *, {MONTH} AS period, {THREE_CLASS} AS sentiment FROM reviews)"

SILVER = """silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY Review_Text ORDER BY row_id) AS rn FROM labelled)
  WHERE rn = 1 AND sentiment IS NOT NULL AND Review_Text IS NOT NULL)"""

SPLITS = """splits AS (
  SELECT row_id, sentiment, CASE WHEN rn <= floor(n*0.7+0.5) THEN 'train'
    WHEN rn <= floor(n*0.85+0.5) THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT row_id, sentiment,
      row_number() OVER (PARTITION BY sentiment ORDER BY md5(concat(CAST(row_id AS VARCHAR),':42')), row_id) AS rn,
      count(*) OVER (PARTITION BY sentiment) AS n FROM silver))"""


def even(expression: str, digits: int) -> str:
    """Ties-to-even rounding of a double."""
    return f"(round_even(({expression}) * 1e{digits}, 0) / 1e{digits})"


def share(part: str, whole: str, digits: int = 2) -> str:
    return even(f"CAST({part} AS DOUBLE) / ({whole}) * 100.0", digits)


def text_metrics(source: str, keep: str = "*") -> str:
    """A CTE body that adds the thirteen metrics to ``source``."""
    t = "Review_Text"
    ratio = even("CAST(n_unique_words AS DOUBLE)/nullif(n_tokens,0)", 4)
    mean = even("CAST(n_chars AS DOUBLE)/nullif(n_words,0)", 2)
    caps = even("CAST(n_upper AS DOUBLE)/nullif(n_chars,0)", 4)
    return f"""(SELECT * EXCLUDE (lex), {ratio} AS unique_ratio, {mean} AS mean_word_len, {caps} AS caps_ratio FROM (
      SELECT *, CAST(len(lex) AS INTEGER) AS n_tokens, CAST(len(list_distinct(lex)) AS INTEGER) AS n_unique_words FROM (
        SELECT {keep}, CAST(length({t}) AS INTEGER) AS n_chars,
          CAST(len(regexp_extract_all({t},'\\S+')) AS INTEGER) AS n_words,
          CASE WHEN {t} IS NOT NULL THEN CAST(greatest(len(regexp_extract_all({t},'[.!?]+(?:\\s|$)')),1) AS INTEGER) END AS n_sentences,
          coalesce(regexp_extract_all(lower({t}),'[a-z'']+'),[]) AS lex,
          CAST(len(regexp_extract_all({t},'[A-Z]')) AS INTEGER) AS n_upper,
          CAST(len(regexp_extract_all({t},'!')) AS INTEGER) AS n_exclaim,
          CAST(len(regexp_extract_all({t},'\\?')) AS INTEGER) AS n_question,
          coalesce(regexp_matches({t},'(?i)https?://|www\\.'),false) AS has_url,
          coalesce(regexp_matches({t},'[\\x{{1F300}}-\\x{{1F9FF}}\\x{{2600}}-\\x{{27BF}}\\x{{1FA70}}-\\x{{1FAFF}}]'),false) AS has_emoji
        FROM {source})))"""


ANALYSED = f"analysed AS {text_metrics('labelled')}"
MODEL_TEXT = "regexp_replace(lower(coalesce(Review_Text,'')),'http\\S+|www\\.\\S+','','g')"
FREQUENCY_TEXT = (
    "trim(regexp_replace(regexp_replace(regexp_replace(lower(Review_Text),'https?://\\S+',' ','g'),"
    "'[^a-z\\s'']',' ','g'),'\\s+',' ','g'))"
)
MODEL_TOKENS = "regexp_extract_all(lower({0}),'[\\p{{L}}\\p{{N}}_]{{2,}}')"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


RAW = with_(REVIEWS)
LAB = with_(REVIEWS, LABELLED)
CLEAN = with_(REVIEWS, LABELLED, SILVER)
SPLIT_CTES = (REVIEWS, LABELLED, SILVER, SPLITS)
SPLIT_SQL = with_(*SPLIT_CTES)
MET = with_(REVIEWS, LABELLED, ANALYSED)

SIX = ", ".join(REVIEW_COLUMNS)
PLAIN_LIST = ", ".join(["row_id", *[c for c in REVIEW_COLUMNS if c != "Review_Text"]])


def quoted(words: list[str]) -> str:
    return "[" + ",".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def describe(source_ctes: str, table: str, columns: list[str]) -> str:
    lines = []
    for c in columns:
        v = f"CAST({c} AS DOUBLE)"
        stats = {
            "mean": f"avg({v})",
            "std": f"stddev_samp({v})",
            "min": f"min({v})",
            "q25": f"quantile_cont({v},0.25)",
            "q50": f"quantile_cont({v},0.5)",
            "q75": f"quantile_cont({v},0.75)",
            "max": f"max({v})",
        }
        cells = ", ".join(f"{even(e, 3)} AS {k}" for k, e in stats.items())
        lines.append(f"SELECT '{c}' AS metric, count({c}) AS count, {cells} FROM {table}")
    return source_ctes + "\nUNION ALL\n".join(lines)


def issue_counts() -> dict[str, str]:
    """Scalar SQL of each issue count."""
    t = "Review_Text"
    words = f"len(regexp_extract_all({t},'\\S+'))"
    nulls = " + ".join(f"count_if({c} IS NULL)" for c in REVIEW_COLUMNS)
    counts = [
        f"SELECT {nulls} FROM reviews",
        f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {SIX} FROM reviews)) FROM reviews",
        "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT Review_ID FROM reviews)) FROM reviews",
        f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {t} FROM reviews)) FROM reviews",
        f"SELECT count_if(regexp_matches({t},'^\\s*$')) FROM reviews",
        f"SELECT count_if({words} < 3) FROM reviews",
        f"SELECT count_if({words} > 1000) FROM reviews",
        f"SELECT count_if(NOT coalesce(regexp_matches({t},'[A-Za-z]'),false)) FROM reviews",
        f"SELECT count_if(regexp_matches({t},'(?i)https?://|www\\.')) FROM reviews",
        f"SELECT count_if(regexp_matches({t},'[\\x{{1F300}}-\\x{{1F9FF}}\\x{{2600}}-\\x{{27BF}}\\x{{1FA70}}-\\x{{1FAFF}}]')) FROM reviews",
        f"SELECT count_if(regexp_matches({t},'[^\\x00-\\x7F]')) FROM reviews",
        "SELECT count_if(NOT coalesce(Rating BETWEEN 1 AND 5,false)) FROM reviews",
        "SELECT count_if(Year_Month = 'missing') FROM reviews",
        "SELECT count_if(NOT coalesce(regexp_matches(Year_Month,'^\\d{4}-\\d{1,2}$'),false) AND Year_Month IS DISTINCT FROM 'missing') FROM reviews",
    ]
    return dict(zip(ISSUE_IDS.values(), counts))


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rank_expression(column: str, partition: str = "") -> str:
    extra = f"PARTITION BY {partition} " if partition else ""
    tie = f"{partition}, {column}" if partition else column
    return f"rank() OVER ({extra}ORDER BY {column}) + (count(*) OVER (PARTITION BY {tie})-1)/2.0"


def spearman(a: str, b: str, table: str, digits: int) -> str:
    return f"""SELECT '{a}' AS "left", '{b}' AS "right", {even('corr(x,y)', digits)} AS rho FROM (
      SELECT {rank_expression('a')} AS x, {rank_expression('b')} AS y FROM (
        SELECT CAST({a} AS DOUBLE) AS a, CAST({b} AS DOUBLE) AS b FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL))"""


def token_rows(stop_words: list[str] | None) -> str:
    tokens = MODEL_TOKENS.format("Review_Text")
    if stop_words:
        tokens = f"list_filter({tokens}, lambda x: NOT list_contains({quoted(stop_words)}, x))"
    return f"tok AS (SELECT row_id, sentiment, {tokens} AS t FROM labelled)"


def grams(size: int) -> str:
    if size == 1:
        return "SELECT row_id, sentiment, unnest(t) AS ngram FROM tok"
    joined = " || ' ' || ".join(f"t[i+{k}]" if k else "t[i]" for k in range(size))
    return f"SELECT row_id, sentiment, {joined} AS ngram FROM (SELECT row_id, sentiment, t, unnest(range(1, len(t)-{size}+2)) AS i FROM tok)"


NUMERIC_LIST = list(NUMERIC_FEATURES)
FILLED = ", ".join(f"coalesce(CAST({c} AS DOUBLE),0.0) AS {c}" for c in NUMERIC_LIST)


def feature_ctes(held: str = "validation") -> list[str]:
    """TF-IDF and scaled numbers of the training and of the scored split."""
    tokens = MODEL_TOKENS.format(MODEL_TEXT)
    mean = {c: f"(SELECT avg({c}) FROM train)" for c in NUMERIC_LIST}
    std = {c: f"(SELECT CASE WHEN stddev_pop({c})=0 THEN 1.0 ELSE stddev_pop({c}) END FROM train)" for c in NUMERIC_LIST}
    scaled = ", ".join(f"({c}-{mean[c]})/{std[c]} AS {c}" for c in NUMERIC_LIST)
    return [
        *SPLIT_CTES,
        f"rows_ AS (SELECT row_id, sentiment, split, {tokens} AS t, Review_Text FROM silver JOIN splits USING (row_id, sentiment) WHERE split IN ('train','{held}'))",
        f"numbers AS MATERIALIZED (SELECT row_id, sentiment, split, {FILLED} FROM {text_metrics('rows_')})",
        "train AS (SELECT * FROM numbers WHERE split='train')",
        f"standard AS MATERIALIZED (SELECT row_id, sentiment, split, {scaled} FROM numbers)",
        "tf AS MATERIALIZED (SELECT row_id, sentiment, split, term, count(*) AS tf FROM (SELECT row_id, sentiment, split, unnest(t) AS term FROM rows_) GROUP BY ALL)",
        "n_train AS (SELECT count(*) AS n FROM rows_ WHERE split='train')",
        "vocabulary AS MATERIALIZED (SELECT term, count(*) AS df, ln((1.0+(SELECT n FROM n_train))/(1.0+count(*)))+1.0 AS idf FROM tf WHERE split='train' GROUP BY term)",
        "weights AS MATERIALIZED (SELECT row_id, sentiment, split, term, tf*idf / sqrt(sum(tf*idf*tf*idf) OVER (PARTITION BY row_id)) AS weight FROM tf JOIN vocabulary USING (term))",
    ]


def unit_range_ctes(held: str = "validation") -> list[str]:
    low = {c: f"(SELECT min({c}) FROM standard WHERE split='train')" for c in NUMERIC_LIST}
    span = {c: f"(SELECT CASE WHEN max({c})=min({c}) THEN 1.0 ELSE max({c})-min({c}) END FROM standard WHERE split='train')" for c in NUMERIC_LIST}
    unit = ", ".join(f"({c}-{low[c]})/{span[c]} AS {c}" for c in NUMERIC_LIST)
    return [
        *feature_ctes(held),
        "scales AS MATERIALIZED (SELECT term, max(abs(weight)) AS scale FROM weights WHERE split='train' GROUP BY term)",
        f"unit AS MATERIALIZED (SELECT row_id, sentiment, split, {unit} FROM standard)",
        f"""matrix AS MATERIALIZED (
          SELECT row_id, sentiment, split, 'term:' || term AS feature, weight/scale AS value FROM weights JOIN scales USING (term)
          UNION ALL SELECT row_id, sentiment, split, 'number:' || name AS feature, value FROM
            (UNPIVOT unit ON {', '.join(NUMERIC_LIST)} INTO NAME name VALUE value))""",
    ]


def bayes_ctes(held: str = "validation") -> list[str]:
    mass = ", ".join(f"sum(CASE WHEN sentiment='{c}' THEN value ELSE 0.0 END)+1.0 AS m_{c}" for c in LABELS)
    logs = ", ".join(f"ln(m_{c}/(SELECT sum(m_{c}) FROM mass)) AS l_{c}" for c in LABELS)
    sums = ", ".join(f"sum(value*l_{c}) AS s_{c}" for c in LABELS)
    prior = {c: f"(SELECT ln(count_if(sentiment='{c}')/CAST(count(*) AS DOUBLE)) FROM rows_ WHERE split='train')" for c in LABELS}
    joint = ", ".join(f"coalesce(s_{c},0.0)+{prior[c]} AS j_{c}" for c in LABELS)
    top = "greatest(" + ",".join(f"j_{c}" for c in LABELS) + ")"
    total = "+".join(f"exp(j_{c}-{top})" for c in LABELS)
    chances = ", ".join(f"exp(j_{c}-{top})/({total}) AS p_{c}" for c in LABELS)
    pick = " ".join(f"WHEN j_{c}={top} THEN '{c}'" for c in LABELS)
    return [
        *unit_range_ctes(held),
        f"mass AS MATERIALIZED (SELECT feature, {mass} FROM matrix WHERE split='train' GROUP BY feature)",
        f"logs AS MATERIALIZED (SELECT feature, {logs} FROM mass)",
        f"sums AS (SELECT row_id, {sums} FROM matrix JOIN logs USING (feature) WHERE split='{held}' GROUP BY row_id)",
        f"joints AS MATERIALIZED (SELECT r.row_id, r.sentiment, {joint} FROM rows_ r LEFT JOIN sums USING (row_id) WHERE split='{held}')",
        f"bayes AS MATERIALIZED (SELECT row_id, sentiment, CASE {pick} END AS prediction, {chances} FROM joints)",
    ]


FOLDS = 5


def fold_cte(source: str) -> str:
    """``folds``: equal shares of each class of ``source``, in order of a hash."""
    passed = "+".join(f"CAST(rn > floor(n*CAST({i / FOLDS} AS DOUBLE)+0.5) AS INTEGER)" for i in range(1, FOLDS))
    return f"""folds AS MATERIALIZED (SELECT row_id, sentiment, {passed} AS fold FROM (SELECT row_id, sentiment,
      row_number() OVER (PARTITION BY sentiment ORDER BY md5(concat(CAST(row_id AS VARCHAR),':43')), row_id) AS rn,
      count(*) OVER (PARTITION BY sentiment) AS n FROM {source}))"""


def fold_bayes_ctes(features: str = "%") -> list[str]:
    """Naive Bayes fitted once for each fold ``j`` on the rows of the other folds, scored on its own.

    ``features`` is a pattern of the feature names that the models see.
    """
    tokens = MODEL_TOKENS.format(MODEL_TEXT)
    mass = ", ".join(f"sum(CASE WHEN sentiment='{c}' THEN value ELSE 0.0 END)+1.0 AS m_{c}" for c in LABELS)
    logs = ", ".join(f"ln(m_{c}/sum(m_{c}) OVER (PARTITION BY j)) AS l_{c}" for c in LABELS)
    sums = ", ".join(f"sum(value*l_{c}) AS s_{c}" for c in LABELS)
    priors = ", ".join(f"ln(count_if(sentiment='{c}')/CAST(count(*) AS DOUBLE)) AS q_{c}" for c in LABELS)
    joint = ", ".join(f"coalesce(s_{c},0.0)+q_{c} AS j_{c}" for c in LABELS)
    top = "greatest(" + ",".join(f"j_{c}" for c in LABELS) + ")"
    total = "+".join(f"exp(j_{c}-{top})" for c in LABELS)
    chances = ", ".join(f"exp(j_{c}-{top})/({total}) AS p_{c}" for c in LABELS)
    pick = " ".join(f"WHEN j_{c}={top} THEN '{c}'" for c in LABELS)
    return [
        *SPLIT_CTES,
        fold_cte("(SELECT * FROM splits WHERE split='train')"),
        f"rows_ AS (SELECT row_id, sentiment, fold, {tokens} AS t, Review_Text FROM silver JOIN folds USING (row_id, sentiment))",
        f"numbers AS MATERIALIZED (SELECT row_id, sentiment, fold, {FILLED} FROM {text_metrics('rows_')})",
        f"models AS (SELECT unnest(range(0,{FOLDS})) AS j)",
        "sizes AS (SELECT j, count(*) AS n, " + priors + " FROM rows_ JOIN models ON fold<>j GROUP BY j)",
        "tf AS MATERIALIZED (SELECT row_id, sentiment, fold, term, count(*) AS tf FROM (SELECT row_id, sentiment, fold, unnest(t) AS term FROM rows_) GROUP BY ALL)",
        "vocabulary AS MATERIALIZED (SELECT j, term, ln((1.0+any_value(n))/(1.0+count(*)))+1.0 AS idf FROM tf JOIN sizes ON fold<>j GROUP BY j, term)",
        "weights AS MATERIALIZED (SELECT j, row_id, sentiment, fold, term, tf*idf / sqrt(sum(tf*idf*tf*idf) OVER (PARTITION BY j, row_id)) AS weight FROM tf JOIN vocabulary USING (term))",
        "scales AS MATERIALIZED (SELECT j, term, max(abs(weight)) AS scale FROM weights WHERE fold<>j GROUP BY j, term)",
        f"long AS MATERIALIZED (SELECT row_id, sentiment, fold, name, x FROM (UNPIVOT numbers ON {', '.join(NUMERIC_LIST)} INTO NAME name VALUE x))",
        "ranges AS (SELECT j, name, min(x) AS low, CASE WHEN max(x)=min(x) THEN 1.0 ELSE max(x)-min(x) END AS span FROM long JOIN models ON fold<>j GROUP BY j, name)",
        """matrix AS MATERIALIZED (
          SELECT j, row_id, sentiment, fold, 'term:' || term AS feature, weight/scale AS value FROM weights JOIN scales USING (j, term)
          UNION ALL SELECT j, row_id, sentiment, fold, 'number:' || name, (x-low)/span FROM long JOIN ranges USING (name))""",
        f"mass AS MATERIALIZED (SELECT j, feature, {mass} FROM matrix WHERE fold<>j AND feature LIKE '{features}' GROUP BY j, feature)",
        f"logs AS MATERIALIZED (SELECT j, feature, {logs} FROM mass)",
        f"sums AS (SELECT row_id, {sums} FROM matrix JOIN logs USING (j, feature) WHERE fold=j GROUP BY row_id)",
        f"joints AS MATERIALIZED (SELECT r.row_id, r.sentiment, r.fold, {joint} FROM rows_ r JOIN sizes ON r.fold=sizes.j LEFT JOIN sums USING (row_id))",
        f"oof AS MATERIALIZED (SELECT row_id, sentiment, fold, CASE {pick} END AS prediction, {chances} FROM joints)",
    ]


MAJORITY_SQL = "(SELECT sentiment FROM splits WHERE split='train' GROUP BY sentiment ORDER BY count(*) DESC, sentiment LIMIT 1)"


def score_ctes(source: str) -> list[str]:
    """Confusion counts and scores per model of a ``preds`` table with p_<label> columns."""
    cells = ", ".join(
        f"count_if(sentiment='{t}' AND prediction='{p}') AS c_{t}_{p}" for t in LABELS for p in LABELS
    )
    values = []
    for c in LABELS:
        support = "+".join(f"c_{c}_{p}" for p in LABELS)
        predicted = "+".join(f"c_{t}_{c}" for t in LABELS)
        hit = f"CAST(c_{c}_{c} AS DOUBLE)"
        values.append(
            f"SELECT model, '{c}' AS label, coalesce({hit}/nullif({predicted},0),0.0) AS precision, "
            f"coalesce({hit}/nullif({support},0),0.0) AS recall, "
            f"coalesce(2*{hit}/nullif({predicted}+{support},0),0.0) AS f1, CAST({support} AS BIGINT) AS support, "
            f"CAST(c_{c}_{c} AS BIGINT) AS hits FROM counts"
        )
    areas = " UNION ALL ".join(
        f"""SELECT model, '{c}' AS label, (sum(CASE WHEN pos THEN rk ELSE 0.0 END) - p*(p+1)/2.0)/(p*q) AS auc FROM (
          SELECT model, sentiment='{c}' AS pos, {rank_expression(f'p_{c}', 'model')} AS rk,
            CAST(count_if(sentiment='{c}') OVER (PARTITION BY model) AS DOUBLE) AS p,
            CAST(count_if(sentiment<>'{c}') OVER (PARTITION BY model) AS DOUBLE) AS q
          FROM {source} WHERE p_{c} IS NOT NULL) GROUP BY model, p, q"""
        for c in LABELS
    )
    return [
        f"counts AS MATERIALIZED (SELECT model, {cells} FROM {source} GROUP BY model)",
        "classes AS MATERIALIZED (" + " UNION ALL ".join(values) + ")",
        f"areas AS MATERIALIZED ({areas})",
        "board AS (SELECT model, sum(hits)/CAST(sum(support) AS DOUBLE) AS accuracy, avg(f1) AS macro_f1, "
        "(SELECT avg(auc) FROM areas a WHERE a.model=classes.model) AS auc_roc FROM classes GROUP BY model)",
    ]


def rule_ctes() -> list[str]:
    rules = {
        "length": ("1+n_words%5", "1+n_chars%4", "2+n_words%7"),
        "rating": ("1+Review_ID%3", "1+n_chars%3", "4+n_words%2"),
    }
    parts = []
    for name, (a, b, c) in rules.items():
        parts.append(
            f"""SELECT '{name}' AS model, row_id, sentiment,
              CASE WHEN a>=b AND a>=c THEN 'negative' WHEN b>=c THEN 'neutral' ELSE 'positive' END AS prediction,
              CAST(a AS DOUBLE)/CAST(a+b+c AS DOUBLE) AS p_negative, CAST(b AS DOUBLE)/CAST(a+b+c AS DOUBLE) AS p_neutral,
              CAST(c AS DOUBLE)/CAST(a+b+c AS DOUBLE) AS p_positive
            FROM (SELECT row_id, sentiment, {a} AS a, {b} AS b, {c} AS c FROM analysed WHERE Review_Text IS NOT NULL AND sentiment IS NOT NULL)"""
        )
    parts.append(
        "SELECT 'always positive' AS model, row_id, sentiment, 'positive' AS prediction, "
        "CAST(NULL AS DOUBLE) AS p_negative, CAST(NULL AS DOUBLE) AS p_neutral, CAST(NULL AS DOUBLE) AS p_positive FROM analysed WHERE Review_Text IS NOT NULL AND sentiment IS NOT NULL"
    )
    return [REVIEWS, LABELLED, ANALYSED, "preds AS MATERIALIZED (" + " UNION ALL ".join(parts) + ")", *score_ctes("preds")]


def oracle() -> dict[str, str]:
    sql: dict[str, str] = {}

    # scans and layers
    sql["s1_scan_csv"] = sql["s11_export_overwrite"] = with_(PLAIN_REVIEWS) + f"SELECT {SIX} FROM reviews"
    sql["s3_contract"] = RAW + (
        "SELECT count(Rating) AS rated, CAST(count_if(Rating NOT BETWEEN 1 AND 5) AS BIGINT) AS violations, "
        "min(Rating) AS lowest, max(Rating) AS highest FROM reviews"
    )
    sql["s4_text_digests"] = RAW + "SELECT row_id, md5(Review_Text) AS md5, sha256(Review_Text) AS sha256 FROM reviews"
    sql["s5_write_silver"] = sql["c9_clean"] = CLEAN + "SELECT * FROM silver"
    sql["s6_load_silver"] = CLEAN + "SELECT row_id, Review_ID, period, sentiment FROM silver"
    sql["s7_save_splits"] = SPLIT_SQL + "SELECT split, 42 AS seed, count(*) AS rows FROM splits GROUP BY split"
    sql["s8_load_splits"] = sql["s9_build_splits_once"] = SPLIT_SQL + "SELECT row_id, split, 42 AS seed FROM splits"
    sql["s10_subset"] = SPLIT_SQL + (
        "SELECT row_id, Review_ID, silver.sentiment, Review_Text FROM silver JOIN splits USING (row_id) WHERE split='validation'"
    )

    # cleaning
    def first_of(keys: str) -> str:
        return RAW + (
            f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY row_id) AS rn FROM reviews) WHERE rn=1"
        )

    sql["c1_drop_full_duplicates"] = first_of(SIX)
    sql["c2_drop_duplicate_texts"] = first_of("Review_Text")
    sql["c3_period"] = LAB + "SELECT row_id, Year_Month, period FROM labelled"
    sql["c4_sentiment_three_class"] = LAB + "SELECT row_id, Rating, sentiment FROM labelled"
    sql["c5_sentiment_binary"] = RAW + f"SELECT row_id, Rating, {BINARY} AS sentiment FROM reviews"
    sql["c6_unknown_scheme"] = RAW + "SELECT count(*) AS rows, 'ValueError' AS error FROM reviews"
    sql["c7_drop_unusable"] = LAB + (
        f"SELECT {PLAIN_LIST}, sentiment FROM labelled WHERE sentiment IS NOT NULL AND Review_Text IS NOT NULL"
    )
    sql["c10_funnel"] = LAB + f"""SELECT (SELECT count(*) FROM labelled) AS rows_in,
      (SELECT count(*) FROM labelled) - (SELECT count(*) FROM (SELECT DISTINCT {SIX} FROM labelled)) AS full_duplicates,
      (SELECT count(*) FROM (SELECT DISTINCT {SIX} FROM labelled)) - (SELECT count(*) FROM (SELECT DISTINCT Review_Text FROM labelled)) AS further_duplicate_texts,
      CAST(count_if(sentiment IS NULL OR Review_Text IS NULL) AS BIGINT) AS unusable,
      CAST(count_if(sentiment IS NOT NULL AND Review_Text IS NOT NULL) AS BIGINT) AS rows_out
      FROM (SELECT *, row_number() OVER (PARTITION BY Review_Text ORDER BY row_id) AS rn FROM labelled) WHERE rn=1"""
    sql["c11_drop_target"] = LAB + "SELECT * EXCLUDE (sentiment, Review_Text) FROM labelled"
    sql["c13_class_filter"] = LAB + f"SELECT {PLAIN_LIST}, sentiment FROM labelled WHERE sentiment='negative'"
    sql["c14_dated_rows"] = LAB + "SELECT row_id, period FROM labelled WHERE period IS NOT NULL"
    sql["c15_preview"] = RAW + "SELECT * FROM reviews ORDER BY row_id LIMIT 3"

    # text metrics
    for key, metric in METRIC_IDS.items():
        sql[f"{key}_{metric}"] = MET + f"SELECT row_id, {metric} FROM analysed"
    sql["t_all_text_metrics"] = MET + "SELECT row_id, " + ", ".join(METRIC_IDS.values()) + " FROM analysed"
    sql["t14_non_ascii"] = RAW + "SELECT row_id, coalesce(regexp_matches(Review_Text,'[^\\x00-\\x7F]'),false) AS non_ascii FROM reviews"
    sql["t15_model_text"] = RAW + f"SELECT row_id, {MODEL_TEXT} AS normalised FROM reviews"
    sql["t16_frequency_text"] = RAW + f"SELECT row_id, {FREQUENCY_TEXT} AS normalised FROM reviews"
    sql["t17_model_tokens"] = RAW + (
        "SELECT row_id, CAST(i-1 AS INTEGER) AS position, t[i] AS token FROM (SELECT row_id, t, unnest(range(1,len(t)+1)) AS i FROM "
        f"(SELECT row_id, {MODEL_TOKENS.format('Review_Text')} AS t FROM reviews))"
    )
    sql["t18_whitespace_split"] = RAW + (
        "SELECT row_id, CAST(i-1 AS INTEGER) AS position, t[i] AS word FROM (SELECT row_id, t, unnest(range(1,len(t)+1)) AS i FROM "
        f"(SELECT row_id, regexp_extract_all({FREQUENCY_TEXT},'\\S+') AS t FROM reviews))"
    )
    sql["t19_strip_prefix"] = RAW + "SELECT row_id, replace(Branch,'park_','') AS branch FROM reviews"
    sql["t20_clip"] = MET + "SELECT row_id, CAST(least(n_words,600) AS INTEGER) AS n_words_clipped FROM analysed"
    sql["t21_date_parts"] = LAB + (
        "SELECT row_id, CAST(year(period) AS INTEGER) AS year, CAST(month(period) AS INTEGER) AS month, "
        "CAST(year(period)*12+month(period) AS INTEGER) AS month_index FROM labelled WHERE period IS NOT NULL"
    )
    sql["t22_half_even"] = RAW + (
        f"SELECT row_id, {even('Review_ID/CAST(8 AS DOUBLE)', 2)} AS two, {even('Review_ID/CAST(8 AS DOUBLE)', 0)} AS whole FROM reviews"
    )

    # profiling
    types = {"Review_ID": "bigint", "Rating": "int"}
    kinds = {"Review_ID": "bigint", "Rating": "int"}
    sql["p1_approximate_inventory"] = RAW + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{kinds.get(c, 'string')}' AS dtype, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, "
        f"{share(f'count_if({c} IS NULL)', 'count(*)')} AS pct_null, count(DISTINCT {c}) AS exact, true AS within_three_errors FROM reviews"
        for c in REVIEW_COLUMNS
    )
    sql["p1_column_inventory"] = RAW + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{types.get(c, 'string')}' AS dtype, count(DISTINCT {c}) AS \"unique\", "
        f"CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, {share(f'count_if({c} IS NULL)', 'count(*)')} AS pct_null, "
        f"count(DISTINCT {c}) <= 1 AS constant, count(DISTINCT {c}) = count(*) AS unique_key, CASE WHEN count(DISTINCT {c}) <= 1 THEN 'constant' WHEN count(DISTINCT {c}) = count(*) THEN 'key' WHEN count(DISTINCT {c}) <= 50 THEN 'category' WHEN 2 * count(DISTINCT {c}) > count(*) THEN 'free' ELSE 'repeated' END AS role FROM reviews"
        for c in REVIEW_COLUMNS
    )
    counts = issue_counts()
    for key, issue in ISSUE_IDS.items():
        sql[f"{key}_{ISSUE_NAMES[key]}"] = RAW + f"SELECT {literal(issue)} AS issue, CAST(({counts[issue]}) AS BIGINT) AS count"
    sql["p16_quality_report"] = RAW + "\nUNION ALL\n".join(
        f"SELECT {literal(issue)} AS issue, CAST(({counts[issue]}) AS BIGINT) AS count, "
        f"{share(f'({counts[issue]})', '(SELECT count(*) FROM reviews)')} AS pct, {literal(ACTIONS[issue])} AS suggested_treatment"
        for issue in counts
    )
    summary = [
        "SELECT 'rows' AS measure, '' AS item, CAST(count(*) AS DOUBLE) AS value FROM reviews",
        f"SELECT 'columns', '', CAST({len(REVIEW_COLUMNS)} AS DOUBLE)",
        "SELECT 'missing periods', '', CAST(count_if(Year_Month='missing') AS DOUBLE) FROM reviews",
        "SELECT 'max words', '', CAST(max(len(regexp_extract_all(Review_Text,'\\S+'))) AS DOUBLE) FROM reviews",
        "SELECT 'median words', '', CAST(median(len(regexp_extract_all(Review_Text,'\\S+'))) AS DOUBLE) FROM reviews",
        *[f"SELECT 'nulls', '{c}', CAST(count_if({c} IS NULL) AS DOUBLE) FROM reviews" for c in REVIEW_COLUMNS],
        "SELECT 'rating', CAST(Rating AS VARCHAR), CAST(count(*) AS DOUBLE) FROM reviews WHERE Rating IS NOT NULL GROUP BY Rating",
        "SELECT 'branch', Branch, CAST(count(*) AS DOUBLE) FROM reviews WHERE Branch IS NOT NULL GROUP BY Branch",
        f"SELECT 'majority share', '', {even('(SELECT max(n) FROM (SELECT count(*) AS n FROM reviews WHERE Rating IS NOT NULL GROUP BY Rating))/CAST(count(*) AS DOUBLE)', 6)} FROM reviews",
        *[f"SELECT 'duplicates', '{c}', CAST(count(*)-(SELECT count(*) FROM (SELECT DISTINCT {c} FROM reviews)) AS DOUBLE) FROM reviews" for c in ("Review_ID", "Review_Text")],
    ]
    sql["p17_corpus_summary"] = RAW + "\nUNION ALL\n".join(summary)
    sql["p18_describe_numbers"] = describe(RAW, "reviews", ["Review_ID", "Rating"])
    sql["p19_describe_categories"] = RAW + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, count(DISTINCT {c}) AS \"unique\", "
        f"(SELECT {c} FROM reviews WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
        f"(SELECT max(n) FROM (SELECT count(*) AS n FROM reviews WHERE {c} IS NOT NULL GROUP BY {c})) AS freq FROM reviews"
        for c in ("Year_Month", "Reviewer_Location", "Branch")
    )
    sql["p20_rating_statistics"] = RAW + (
        f"SELECT {even('avg(Rating)', 3)} AS mean, CAST(median(Rating) AS DOUBLE) AS median, "
        "(SELECT Rating FROM reviews WHERE Rating IS NOT NULL GROUP BY Rating ORDER BY count(*) DESC, Rating LIMIT 1) AS mode, "
        f"{even('stddev_samp(Rating)', 3)} AS std, CAST(quantile_cont(Rating,0.25) AS DOUBLE) AS q1, CAST(quantile_cont(Rating,0.75) AS DOUBLE) AS q3 FROM reviews"
    )
    sql["p21_rating_distribution"] = RAW + (
        f"SELECT Rating, count(*) AS count, {share('count(*)', '(SELECT count(*) FROM reviews)')} AS pct FROM reviews WHERE Rating IS NOT NULL GROUP BY Rating"
    )

    def balance(ctes: str, table: str, label: str) -> str:
        per = f"(SELECT {label} AS label, count(*) AS n FROM {table} GROUP BY 1)"
        return ctes + (
            f"SELECT label, n AS count, {share('n', f'(SELECT count(*) FROM {table})')} AS pct, "
            f"{even(f'CAST(n AS DOUBLE)/(SELECT min(n) FROM {per} WHERE label IS NOT NULL)', 1)} AS ratio_vs_smallest FROM {per} WHERE label IS NOT NULL"
        )

    sql["p22_class_balance"] = balance(LAB, "labelled", "sentiment")
    sql["p22_class_balance_binary"] = balance(RAW, "reviews", BINARY)
    sql["flagship_clean_class_balance"] = balance(CLEAN, "silver", "sentiment")
    clean_metrics = with_(REVIEWS, LABELLED, SILVER, f"analysed AS {text_metrics('silver')}")
    sql["p23_feature_ranges"] = clean_metrics + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS metric, {even(f'min(CAST({c} AS DOUBLE))', 2)} AS min, {even(f'avg(CAST({c} AS DOUBLE))', 2)} AS mean, "
        f"{even(f'max(CAST({c} AS DOUBLE))', 2)} AS max FROM analysed"
        for c in RANGE_METRICS
    )
    sql["p24_describe_text_metrics"] = describe(MET, "analysed", DESCRIBED)
    flags = {
        "caps_ratio > 0.30": "caps_ratio > 0.30",
        "more than 10 '!'": "n_exclaim > 10",
        "unique_ratio < 0.30 (repetitive)": "unique_ratio < 0.30",
        "contains a URL": "has_url",
        "contains an emoji": "has_emoji",
    }
    sql["p25_spam_flags"] = MET + "\nUNION ALL\n".join(
        f"SELECT {literal(k)} AS flag, CAST(count_if({v}) AS BIGINT) AS reviews FROM analysed" for k, v in flags.items()
    )
    sql["p26_vocabulary_size"] = RAW + (
        "SELECT CAST(sum(len(regexp_extract_all(lower(Review_Text),'[a-z'']+'))) AS BIGINT) AS total_tokens, "
        f"(SELECT count(DISTINCT w) FROM (SELECT unnest(regexp_extract_all({FREQUENCY_TEXT},'\\S+')) AS w FROM reviews)) AS vocabulary FROM reviews"
    )

    def fence(c: str) -> str:
        return f"(SELECT quantile_cont({c},0.75)+1.5*(quantile_cont({c},0.75)-quantile_cont({c},0.25)) FROM analysed)"

    sql["p27_iqr_outliers"] = MET + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS metric, round_even({fence(c)},0) AS iqr_upper_bound, CAST(count_if({c}>{fence(c)}) AS BIGINT) AS above, "
        f"{share(f'count_if({c}>{fence(c)})', 'count(*)')} AS pct, CAST(max({c}) AS DOUBLE) AS max FROM analysed"
        for c in ("n_words", "n_chars", "n_sentences")
    )
    per_class = ", ".join(share(f"count_if(sentiment='{c}')", "count(*)", 1) + f" AS {c}" for c in LABELS)
    spark_types = {
        "row_id": "bigint",
        "Review_ID": "bigint",
        "period": "date",
        **dict.fromkeys(("unique_ratio", "mean_word_len", "caps_ratio"), "double"),
        **dict.fromkeys(("has_url", "has_emoji"), "boolean"),
        **dict.fromkeys((*TEXT_COLUMNS, "sentiment"), "string"),
    }
    listed = ["row_id", *REVIEW_COLUMNS, *METRIC_IDS.values(), "period", "sentiment"]
    sql["p28_column_types"] = MET + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{spark_types.get(c, 'int')}' AS dtype, count({c}) AS non_null FROM analysed" for c in listed
    )
    sql["p30_split_summary"] = SPLIT_SQL + (
        f"SELECT split, count(*) AS rows, {share('count(*)', '(SELECT count(*) FROM splits)', 1)} AS pct, {per_class} FROM splits GROUP BY split"
    )

    # groups and time
    sql["g1_branch_report"] = MET + (
        f"SELECT Branch, count(*) AS reviews, {even('avg(Rating)', 3)} AS mean_rating, {even('CAST(median(Rating) AS DOUBLE)', 3)} AS median_rating, "
        f"{even('CAST(median(n_words) AS DOUBLE)', 3)} AS median_words, {share('count(*)', '(SELECT count(*) FROM analysed)', 1)} AS pct_of_corpus "
        "FROM analysed WHERE Branch IS NOT NULL GROUP BY Branch"
    )
    sql["g2_mean_rating_by_branch"] = RAW + (
        f"SELECT replace(Branch,'park_','') AS branch, {even('avg(Rating)', 6)} AS mean, count(*) AS size FROM reviews GROUP BY Branch"
    )
    shares = ", ".join(even(f"count_if(sentiment='{c}')/CAST(count(*) AS DOUBLE)*100.0", 6) + f" AS {c}" for c in LABELS)
    sql["g3_sentiment_by_branch"] = LAB + f"SELECT Branch, {shares} FROM labelled WHERE sentiment IS NOT NULL GROUP BY Branch"
    domain = ", ".join(f"({i}, '{c}')" for i, c in enumerate(LABELS))
    sql["g4_sentiment_distribution"] = LAB + (
        f"SELECT CAST(d.position AS INTEGER) AS position, d.sentiment, n AS count, {even('n/CAST((SELECT count(sentiment) FROM labelled) AS DOUBLE)*100.0', 6)} AS pct "
        f"FROM (VALUES {domain}) d(position, sentiment) LEFT JOIN (SELECT sentiment, count(*) AS n FROM labelled GROUP BY 1) c USING (sentiment)"
    )
    sql["g5_monthly_volume"] = LAB + "SELECT period, count(*) AS reviews FROM labelled WHERE period IS NOT NULL GROUP BY period"
    for key, least in (("g6_monthly_rating", 30), ("g6_monthly_rating_from_8", 8)):
        sql[key] = LAB + (
            f"SELECT period, {even('avg(Rating)', 6)} AS mean_rating FROM labelled WHERE period IS NOT NULL GROUP BY period HAVING count(*) >= {least}"
        )
    sql["g7_yearly_report"] = LAB + (
        f"SELECT CAST(year(period) AS INTEGER) AS year, count(*) AS reviews, {even('avg(Rating)', 3)} AS mean_rating FROM labelled WHERE period IS NOT NULL GROUP BY 1"
    )
    sql["g8_period_range"] = LAB + (
        "SELECT count(period) AS parseable, CAST(count_if(period IS NULL) AS BIGINT) AS unparseable, min(period) AS first_period, max(period) AS last_period FROM labelled"
    )
    sql["g9_length_histogram"] = MET.rstrip() + f""",
      clipped AS (SELECT CAST(least(n_words,600) AS DOUBLE) AS v FROM analysed WHERE n_words IS NOT NULL),
      edges AS (SELECT min(v) AS lo, max(v) AS hi FROM clipped),
      counts AS (SELECT least(CAST(floor((v-lo)*60.0/(hi-lo)) AS INT)+1,60) AS bin, count(*) AS n FROM clipped, edges GROUP BY 1)
      SELECT CAST(b AS INTEGER) AS bin, {even('lo+(b-1)*(hi-lo)/60.0', 6)} AS lower, {even('lo+b*(hi-lo)/60.0', 6)} AS upper, coalesce(n,0) AS n,
        CAST((SELECT median(n_words) FROM analysed) AS DOUBLE) AS median
      FROM (SELECT unnest(range(1,61)) AS b) CROSS JOIN edges LEFT JOIN counts ON counts.bin=b"""
    sql["g10_length_boxes"] = MET.rstrip() + """,
      q AS (SELECT Rating, count(n_words) AS n, quantile_cont(n_words,0.25) AS q1, CAST(median(n_words) AS DOUBLE) AS median, quantile_cont(n_words,0.75) AS q3
            FROM analysed WHERE Rating IS NOT NULL GROUP BY Rating)
      SELECT q.Rating, q.n, CAST(least(min(CASE WHEN n_words >= q1-1.5*(q3-q1) THEN n_words END), any_value(q1)) AS DOUBLE) AS whisker_low,
        any_value(q1) AS q1, any_value(q.median) AS median, any_value(q3) AS q3,
        CAST(greatest(max(CASE WHEN n_words <= q3+1.5*(q3-q1) THEN n_words END), any_value(q3)) AS DOUBLE) AS whisker_high
      FROM analysed a JOIN q ON a.Rating=q.Rating GROUP BY q.Rating, q.n"""
    sql["g11_median_words_by_rating"] = MET + (
        "SELECT Rating, count(n_words) AS reviews, CAST(median(n_words) AS DOUBLE) AS median_words FROM analysed WHERE Rating IS NOT NULL GROUP BY Rating"
    )

    # correlation
    timed = MET.rstrip() + ",\n timed AS (SELECT *, year(period)*12+month(period) AS time_index FROM analysed)\n"
    pairs = [("Review_ID", "time_index"), ("Review_ID", "Rating"), ("n_words", "Rating"), ("n_chars", "n_words")]
    sql["r1_leakage_checks"] = timed + "\nUNION ALL\n".join(spearman(a, b, "timed", 4) for a, b in pairs)
    sql["r2_spearman_matrix"] = MET + "\nUNION ALL\n".join(
        spearman(a, b, "analysed", 6) for a in MATRIX_COLUMNS for b in MATRIX_COLUMNS
    )

    # n-grams
    english = with_(REVIEWS, LABELLED, token_rows(list(ENGLISH)))

    def top(ctes: str, body: str, limit: int) -> str:
        return ctes + f"SELECT ngram, count(*) AS count FROM ({body}) GROUP BY ngram ORDER BY count DESC, ngram LIMIT {limit}"

    sql["n1_top_unigrams"] = top(english, grams(1), 15)
    sql["n2_top_bigrams"] = top(english, grams(2), 15)
    sql["n3_ngram_range"] = with_(REVIEWS, LABELLED, token_rows(None)) + (
        "SELECT ngram, count(*) AS count FROM (" + " UNION ALL ".join(grams(i) for i in (1, 2, 3)) + ") GROUP BY ngram"
    )
    sql["n4_top_bigrams_by_class"] = english + (
        "SELECT sentiment, CAST(rn AS INTEGER) AS rank, ngram, n AS count FROM (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY n DESC, ngram) AS rn "
        f"FROM (SELECT sentiment, ngram, count(*) AS n FROM ({grams(2)}) WHERE sentiment IS NOT NULL GROUP BY ALL)) WHERE rn <= 8"
    )
    own = with_(REVIEWS, LABELLED, token_rows(OWN_STOP_WORDS))
    sql["n5_own_stop_words"] = top(own, grams(1) + " UNION ALL " + grams(2), 20)

    # split
    sql["l1_stratified_split"] = SPLIT_SQL + "SELECT row_id, sentiment, split FROM splits"
    sql["l2_features_and_target"] = SPLIT_SQL + (
        "SELECT row_id, Review_ID, Year_Month, silver.sentiment, split AS part FROM silver JOIN splits USING (row_id)"
    )

    sql["l3_temporal_split"] = CLEAN + """, months AS (
      SELECT row_id, Review_ID, period, sentiment, CAST(coalesce(period,
        (SELECT arg_max(o.period, (o.Review_ID, o.period)) FROM silver o WHERE o.period IS NOT NULL AND o.Review_ID < s.Review_ID),
        (SELECT min(period) FROM silver)) AS DATE) AS order_month FROM silver s)
      SELECT row_id, Review_ID, period, sentiment, order_month, CASE WHEN rn <= floor(n*0.7+0.5) THEN 'train' WHEN rn <= floor(n*0.85+0.5) THEN 'validation' ELSE 'test' END AS split
      FROM (SELECT *, row_number() OVER (ORDER BY order_month, Review_ID, row_id) AS rn, count(*) OVER () AS n FROM months)"""

    # learned features
    fitted = with_(*feature_ctes())
    held = "split='validation'"
    scaled_columns = ", ".join(f"{even(c, 6)} AS {c}" for c in NUMERIC_LIST)
    sql["f1_tfidf_vocabulary"] = fitted + f"SELECT term, df, {even('idf', 6)} AS idf FROM vocabulary"
    sql["f2_tfidf_weights"] = fitted + f"SELECT row_id, term, {even('weight', 6)} AS weight FROM weights WHERE {held}"
    sql["f3_standard_scaler"] = fitted + f"SELECT row_id, {scaled_columns} FROM standard WHERE {held}"
    sql["f4_feature_matrix"] = fitted + (
        f"SELECT row_id, 'term:' || term AS feature, {even('weight', 6)} AS value FROM weights WHERE {held} UNION ALL "
        f"SELECT row_id, 'number:' || name AS feature, {even('value', 6)} AS value FROM (UNPIVOT standard ON {', '.join(NUMERIC_LIST)} INTO NAME name VALUE value) WHERE {held}"
    )
    sql["f5_class_weights"] = SPLIT_SQL + (
        f"SELECT sentiment, count(*) AS n, {even('(SELECT count(*) FROM splits WHERE split=$$train$$)/((SELECT count(DISTINCT sentiment) FROM splits WHERE split=$$train$$)*CAST(count(*) AS DOUBLE))', 6)} AS weight "
        "FROM splits WHERE split='train' GROUP BY sentiment"
    )
    sql["f6_feature_vectors"] = f"SELECT * FROM ({sql['f4_feature_matrix']}) WHERE value <> 0"
    unit = with_(*unit_range_ctes())
    sql["f7_max_abs"] = unit + (
        f"SELECT row_id, term, {even('weight/scale', 6)} AS weight FROM weights JOIN scales USING (term) WHERE {held}"
    )
    sql["f8_min_max"] = unit + f"SELECT row_id, {scaled_columns} FROM unit WHERE {held}"
    sql["f9_unit_range_matrix"] = unit + f"SELECT row_id, feature, {even('value', 6)} AS value FROM matrix WHERE {held}"
    sql["f10_feature_exclusion"] = SPLIT_SQL + (
        f"SELECT 'number:' || name AS feature, (SELECT count(*) FROM splits WHERE {held}) AS rows FROM (SELECT unnest({quoted(NUMERIC_LIST)}) AS name)"
    )

    # models
    sql["m1_majority"] = SPLIT_SQL + f"SELECT row_id, sentiment, {MAJORITY_SQL} AS prediction FROM splits WHERE {held}"
    sql["m5_feature_splits"] = with_(*feature_ctes("validation','test")) + (
        f"SELECT r.row_id, {len(NUMERIC_LIST)} + coalesce(n,0) AS entries, r.split FROM rows_ r "
        "LEFT JOIN (SELECT row_id, count(*) AS n FROM weights GROUP BY row_id) w USING (row_id)"
    )
    chances = ", ".join(f"{even(f'p_{c}', 6)} AS p_{c}" for c in LABELS)
    sql["m4_naive_bayes"] = with_(*bayes_ctes()) + f"SELECT row_id, sentiment, prediction, {chances} FROM bayes"
    sql["m4_naive_bayes_test_split"] = with_(*bayes_ctes("test")) + "SELECT row_id, sentiment, prediction FROM bayes"
    majority = ", ".join(f"CAST({MAJORITY_SQL}='{c}' AS DOUBLE) AS p_{c}" for c in LABELS)
    both = (
        "preds AS MATERIALIZED (SELECT 'Multinomial naive Bayes' AS model, row_id, sentiment, prediction, p_negative, p_neutral, p_positive FROM bayes "
        f"UNION ALL SELECT 'Majority class', row_id, sentiment, {MAJORITY_SQL}, {majority} FROM splits WHERE {held})"
    )
    board = f"SELECT model, {even('accuracy', 6)} AS accuracy, {even('auc_roc', 6)} AS auc_roc, {even('macro_f1', 6)} AS macro_f1 FROM board"
    sql["m6_closed_form_board"] = with_(*bayes_ctes(), both, *score_ctes("preds")) + board

    # cross-validation
    sql["l4_stratified_folds"] = with_(REVIEWS, LABELLED, SILVER, fold_cte("silver")) + "SELECT * FROM folds"
    by_fold = "SELECT '{0}' || '/' || fold AS model, row_id, sentiment, {1} AS prediction, {2} FROM {3}"
    none = ", ".join(f"CAST(NULL AS DOUBLE) AS p_{c}" for c in LABELS)
    bayes = by_fold.format("Multinomial naive Bayes", "prediction", ", ".join(f"p_{c}" for c in LABELS), "oof")
    largest = f"SELECT j, arg_max(sentiment, (n, -i)) AS label FROM (SELECT j, sentiment, list_position({quoted(list(LABELS))}, sentiment) AS i, count(*) AS n FROM rows_ JOIN models ON fold<>j GROUP BY ALL) GROUP BY j"
    plain = by_fold.format("Majority class", "label", none, f"oof JOIN ({largest}) ON fold=j")
    scored = "SELECT split_part(model,'/',1) AS model, CAST(split_part(model,'/',2) AS INTEGER) AS fold, CAST(support AS BIGINT) AS rows, accuracy, macro_f1 FROM board JOIN (SELECT model, sum(support) AS support FROM classes GROUP BY model) USING (model)"
    sql["m7_fold_scores"] = with_(*fold_bayes_ctes(), f"preds AS MATERIALIZED ({bayes})", *score_ctes("preds")) + (
        f"SELECT model, fold, rows, {even('accuracy', 6)} AS accuracy, {even('macro_f1', 6)} AS macro_f1 FROM ({scored})"
    )
    sql["m7_cross_validation"] = with_(*fold_bayes_ctes(), f"preds AS MATERIALIZED ({bayes} UNION ALL {plain})", *score_ctes("preds")) + (
        f"SELECT model, count(*) AS folds, {even('avg(macro_f1)', 6)} AS mean, {even('stddev_pop(macro_f1)', 6)} AS sigma FROM ({scored}) GROUP BY model"
    )

    # each configuration is a query of its own, as their tables have the same names
    shown = {"text": "term:%", "numbers": "number:%", "text and numbers": "%"}
    oof = " UNION ALL ".join(f"SELECT '{n}' AS model, * FROM ({with_(*fold_bayes_ctes(p))} SELECT * FROM oof)" for n, p in shown.items())
    judged = f"judged AS MATERIALIZED (SELECT model || '/' || j AS model, sentiment, p_negative, p_neutral, p_positive FROM oofs JOIN (SELECT unnest(range(0,{FOLDS})) AS j) ON fold<>j)"

    def f1_cuts(c: str) -> str:
        return f"""SELECT model, '{c}' AS label, threshold, 2.0*hits/(predicted+support) AS f1 FROM (
          SELECT model, p_{c} AS threshold, sum(count_if(sentiment='{c}')) OVER above AS hits, sum(count(*)) OVER above AS predicted,
            sum(count_if(sentiment='{c}')) OVER (PARTITION BY model) AS support
          FROM judged GROUP BY model, p_{c} WINDOW above AS (PARTITION BY model ORDER BY p_{c} DESC))"""

    ratios = ", ".join(f"p_{c}/greatest(max(CASE WHEN label='{c}' THEN threshold END) OVER (PARTITION BY o.model, row_id), 1e-9) AS r_{c}" for c in LABELS)
    sql["m8_ablation"] = with_(
        f"oofs AS MATERIALIZED ({oof})",
        judged,
        "cuts AS MATERIALIZED (" + " UNION ALL ".join(map(f1_cuts, LABELS)) + ")",
        "best AS MATERIALIZED (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY model, label ORDER BY f1 DESC, threshold DESC)=1)",
        f"ratios AS (SELECT DISTINCT o.model, row_id, fold, sentiment, {ratios} FROM oofs o JOIN best b ON b.model = o.model || '/' || o.fold)",
        f"preds AS MATERIALIZED (SELECT model || '/' || fold AS model, row_id, sentiment, prediction, {none} FROM oofs "
        "UNION ALL SELECT model || ', thresholds/' || fold, row_id, sentiment, CASE WHEN r_negative>=r_neutral AND r_negative>=r_positive THEN 'negative' "
        f"WHEN r_neutral>=r_positive THEN 'neutral' ELSE 'positive' END, {none} FROM ratios)",
        *score_ctes("preds"),
    ) + f"SELECT model, count(*) AS folds, {even('avg(macro_f1)', 6)} AS mean, {even('stddev_pop(macro_f1)', 6)} AS sigma FROM ({scored}) GROUP BY model"

    # metrics
    rules = with_(*rule_ctes())
    cells = "\nUNION ALL\n".join(
        f"SELECT model, '{t}' AS \"true\", '{p}' AS pred, CAST(c_{t}_{p} AS BIGINT) AS n FROM counts" for t in LABELS for p in LABELS
    )
    sql["e1_confusion_matrix"] = rules + cells
    sql["g12_confusion_shares"] = rules + (
        f"SELECT model, \"true\", pred, {even('coalesce(n/nullif(CAST(sum(n) OVER (PARTITION BY model, $$$$ || $X$) AS DOUBLE),0),0.0)', 6)} AS share FROM ({cells})"
    ).replace("$$$$ || $X$", '"true"')
    scores = ", ".join(f"{even(k, 6)} AS {k}" for k in ("precision", "recall", "f1"))
    sql["e2_class_report"] = rules + f"SELECT model, label, {scores}, support FROM classes"
    macro = ", ".join(f"{even(f'avg({k})', 6)} AS {k}" for k in ("precision", "recall", "f1"))
    weighted = ", ".join(
        f"{even(f'sum({k}*support)/CAST(sum(support) AS DOUBLE)', 6)} AS {k}" for k in ("precision", "recall", "f1")
    )
    total = "CAST(sum(support) AS BIGINT) AS support"
    sql["e3_average_report"] = rules + (
        f"SELECT model, 'accuracy' AS average, CAST(NULL AS DOUBLE) AS precision, CAST(NULL AS DOUBLE) AS recall, "
        f"{even('sum(hits)/CAST(sum(support) AS DOUBLE)', 6)} AS f1, {total} FROM classes GROUP BY model "
        f"UNION ALL SELECT model, 'macro avg', {macro}, {total} FROM classes GROUP BY model "
        f"UNION ALL SELECT model, 'weighted avg', {weighted}, {total} FROM classes GROUP BY model"
    )
    sql["e4_macro_f1"] = rules + f"SELECT model, {even('avg(f1)', 6)} AS macro_f1 FROM classes GROUP BY model"
    sql["e5_accuracy"] = rules + f"SELECT model, {even('avg(CAST(prediction=sentiment AS DOUBLE))', 6)} AS accuracy FROM preds GROUP BY model"
    sql["e6_auc_one_vs_rest"] = rules + f"SELECT model, label, {even('auc', 6)} AS auc FROM areas"
    sql["e6_macro_auc"] = rules + f"SELECT model, {even('avg(auc)', 6)} AS auc_roc FROM areas GROUP BY model"
    sql["e7_leaderboard"] = rules + board
    recalls = ", ".join(even(f"max(CASE WHEN label='{c}' THEN recall END)", 6) + f" AS {c}" for c in LABELS)
    sql["e8_recall_by_model"] = rules + f"SELECT model, {recalls} FROM classes GROUP BY model"
    sql["e9_off_majority"] = rules + (
        "SELECT model, CAST(count_if(prediction IS DISTINCT FROM 'positive') AS BIGINT) AS off_majority, count(*) AS predictions FROM preds GROUP BY model"
    )
    replicates = [
        *rule_ctes(),
        """digests AS MATERIALIZED (SELECT model, sentiment, prediction, block, sha256(concat_ws(':', CAST(row_id AS VARCHAR), CAST(block AS VARCHAR), '42')) AS h
          FROM preds CROSS JOIN (SELECT unnest(range(0,25)) AS block))""",
        "bits AS (SELECT model, sentiment, prediction, block*8+place AS replicate, CAST('0x' || substr(h, CAST(8*place+1 AS INTEGER), 8) AS BIGINT) AS bits FROM digests CROSS JOIN (SELECT unnest(range(0,8)) AS place))",
        "drawn AS (SELECT model, replicate, sentiment, prediction, sum(" + "+".join(f"CAST(bits>={s} AS BIGINT)" for s in STEPS) + ") AS n FROM bits GROUP BY ALL)",
        "f1s AS (" + " UNION ALL ".join(
            f"SELECT model, replicate, coalesce(2.0*sum(CASE WHEN sentiment='{c}' AND prediction='{c}' THEN n END)"
            f"/nullif(sum(CASE WHEN sentiment='{c}' THEN n ELSE 0 END)+sum(CASE WHEN prediction='{c}' THEN n ELSE 0 END),0),0.0) AS f1 FROM drawn GROUP BY model, replicate"
            for c in LABELS
        ) + ")",
        "replicates AS MATERIALIZED (SELECT model, CAST(replicate AS INTEGER) AS replicate, avg(f1) AS macro_f1 FROM f1s GROUP BY model, replicate)",
    ]
    sql["e10_bootstrap_replicates"] = with_(*replicates) + f"SELECT model, replicate, {even('macro_f1', 6)} AS macro_f1 FROM replicates"
    sql["e10_bootstrap_interval"] = with_(*replicates) + (
        f"SELECT model, {even('any_value(b.macro_f1)', 6)} AS macro_f1, {even('quantile_cont(r.macro_f1,0.025)', 6)} AS low, "
        f"{even('quantile_cont(r.macro_f1,0.975)', 6)} AS high, count(*) AS replicates FROM replicates r JOIN board b USING (model) GROUP BY model"
    )

    def cuts_of(source: str, by: str) -> str:
        return " UNION ALL ".join(
            f"""SELECT {by}, '{c}' AS label, threshold, hits, predicted, support, 2.0*hits/(predicted+support) AS f1 FROM (
              SELECT {by}, p_{c} AS threshold, CAST(sum(count_if(sentiment='{c}')) OVER above AS BIGINT) AS hits,
                CAST(sum(count(*)) OVER above AS BIGINT) AS predicted, CAST(sum(count_if(sentiment='{c}')) OVER (PARTITION BY {by}) AS BIGINT) AS support
              FROM {source} WHERE p_{c} IS NOT NULL GROUP BY {by}, p_{c} WINDOW above AS (PARTITION BY {by} ORDER BY p_{c} DESC))"""
            for c in LABELS
        )

    cuts = f"cuts AS MATERIALIZED ({cuts_of('preds', 'model')})"
    sql["e11_cut_points"] = with_(*rule_ctes(), cuts) + (
        f"SELECT model, label, {even('threshold', 6)} AS threshold, hits, predicted, support, {even('f1', 6)} AS f1 FROM cuts"
    )
    best = "(SELECT *, row_number() OVER (PARTITION BY model, label ORDER BY f1 DESC, threshold DESC) AS place FROM cuts) WHERE place=1"
    sql["e11_thresholds"] = with_(*rule_ctes(), cuts) + (
        f"SELECT model, label, {even('threshold', 6)} AS threshold, {even('f1', 6)} AS f1 FROM {best}"
    )
    ratio = {c: f"p_{c}/greatest((SELECT threshold FROM best WHERE label='{c}'), 1e-9)" for c in LABELS}
    decided = f"CASE WHEN r_negative>=r_neutral AND r_negative>=r_positive THEN 'negative' WHEN r_neutral>=r_positive THEN 'neutral' ELSE 'positive' END"
    # the two fits have tables of the same names, so each is a query of its own
    fold_cuts = with_(*fold_bayes_ctes(), f"cuts AS MATERIALIZED ({cuts_of('(SELECT 0 AS model, * FROM oof)', 'model')})")
    sql["e11_tuned_bayes"] = with_(
        f"best AS MATERIALIZED (SELECT * FROM ({fold_cuts} SELECT label, threshold FROM {best}))",
        f"held AS MATERIALIZED (SELECT * FROM ({with_(*bayes_ctes())} SELECT * FROM bayes))",
        f"ratios AS (SELECT *, {', '.join(f'{v} AS r_{c}' for c, v in ratio.items())} FROM held)",
        "preds AS MATERIALIZED (SELECT 'plain' AS model, row_id, sentiment, prediction, p_negative, p_neutral, p_positive FROM held "
        f"UNION ALL SELECT 'tuned', row_id, sentiment, {decided}, p_negative, p_neutral, p_positive FROM ratios)",
        *score_ctes("preds"),
    ) + f"SELECT model, {even('macro_f1', 6)} AS macro_f1 FROM board"
    return sql

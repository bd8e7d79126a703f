"""Problem 1: template residue, filler and error-page text in place of content.

A naive Bayes classifier is learnt from trusted positives and unlabelled passages by expectation-maximisation: passages
that match one of a few generic forms (unfilled markup, filler, status phrases) are positive; titles that name nothing of
their page's address start undecided, all others as negative, and get the posterior of the model of the round before. Forms serve as labels only: every passage is scored, and the score
decides. A passage is seen by its words, their neighbours and first letters, its marks, and by what the record
says of it: whether it names anything that the page's address names. The model is a table of
fixed size (hashed features), so a round is one aggregation into at most BUCKETS groups, and scoring needs no join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint, computed, filled, table

#: Size of the hashed model, rounds of EM, and smoothing.
BUCKETS, ROUNDS, SMOOTHING = 1 << 16, 4, 0.1
#: Pseudo-counts that draw a class's rate of a feature to its rate in all passages, so that a rare word of headlines isn't
#: taken for residue only because there are fewer positives; share of the posterior that unlikely passages learn from.
RATE_MASS, UNLIKELY = 2.0, 0.5
#: Generic forms of placeholders, in lower case, which label the passages that the model is learnt from.
MARKED_FORMS = [
    r"\{\{.*\}\}|\{%.*%\}|[$#]\{.*\}|<%.*%>|<!--|\[\[.*\]\]|@@\w|%%\w",  # marks of templates
    r"%\(\w+\)[sd]|(?<!\d)%[sd]\b|\{\d\}",  # marks of formatted text
    r"\[(?:insert|describe|enter|add) |\b(?:goes|tk) here\b|^todo\b",  # notes to whoever fills it in
]
#: Generic forms of whole passages that hold nothing but a placeholder or filler.
FILLER_FORMS = [
    r"^[\[{<$#%@_]+[\w.:!]+[\]}>$#%@_]*$|^[a-z]+_[a-z]+$",  # one name within marks
    r"(?:\b(?:lorem|ipsum|dolor|sit|amet)\b\W*){3}",
    r"^\W*(?:null|undefined|none|nan|untitled|no title|object object|x{3,})\W*$",  # how programs write that nothing is there
]
#: Generic phrases of error pages and notices, which label titles only.
PAGE_FORMS = [
    r"^(?:(?:http|error)\W*)?[45]\d\d\W*(?:not found|forbidden|gone|bad gateway|service unavailable|internal server error)?$",
    r"\bpage (?:was )?not found$|\bpage .*(?:no longer available|does not exist)$",
    r"\b(?:enable|requires?)\b.* ?\b(?:javascript|cookies)\b",
]
#: A title of one or two plain words may be a headline, unless it has one of these.
NEVER_HEADLINES = r"\b(?:page|seite|página|site|headline|title|untitled|null|none|nan|undefined|javascript|js|tk|lorem|asdf|blah|x{3,})\b"
#: Names that a site adds to its titles.
SITE_NAMES = ("tallyboard",)


def trusted(field: str, text: Column) -> Column:
    """Whether a passage matches a trusted form."""
    forms = MARKED_FORMS + (FILLER_FORMS if field != "piece" else []) + (PAGE_FORMS if field == "title" else [])
    return text.rlike("|".join(f"(?:{f})" for f in forms))


def _features(field: str, text: Column, context: Column | None = None) -> Column:
    """Hashed features of a passage: its words, their first letters, pairs of neighbours, marks, and its context.

    Of a piece, what it names and its marks of two count: a single mark may enclose anything.
    """

    def bucket(kind: str, *parts: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(f"{field} {kind}"), *parts), F.lit(BUCKETS)).cast("int")

    if field == "piece":
        words = F.regexp_extract_all(text, F.lit(r"\p{L}{2,}"), 0)
        marks = F.regexp_extract_all(text, F.lit(r"[^\p{L}\p{N}\s.,:;!?’'-]{2}|\p{N}"), 0)
        parts = [F.transform(words, lambda w: bucket("w", w)), F.transform(words, lambda w: bucket("p", F.left(w, F.lit(4)))), F.transform(marks, lambda m: bucket("m", m)), F.array(bucket("any"))]
        return F.array_distinct(F.concat(*parts))
    words = F.regexp_extract_all(text, F.lit(r"[\p{L}’']+|\p{N}|[^\p{L}\p{N}\s]+"), 0)
    following = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    marks = F.regexp_extract_all(text, F.lit(r"[^\p{L}\p{N}\s.,:;!?’'-]{1,2}"), 0)
    parts = [
        F.transform(words, lambda w: bucket("w", w)),
        F.transform(F.filter(words, lambda w: F.length(w) > 4), lambda w: bucket("p", F.left(w, F.lit(4)))),
        F.zip_with(words, following, lambda a, b: bucket("b", a, b)),
        F.transform(marks, lambda m: bucket("m", m)),
        F.array(bucket("own", F.lit("?") if context is None else context)),
    ]
    return F.array_distinct(F.concat(*parts))


def _plain_titles(rows: DataFrame, sites: tuple[str, ...] = SITE_NAMES) -> DataFrame:
    """`rows` with `p_title`: in lower case, blanks collapsed, without simple tags and the site's name at either end.

    Each step is computed once a row, and what few titles need is done for those only.
    """
    names = "|".join(sites)
    rows = computed(rows, {"p_first": F.lower(F.trim(F.regexp_replace(filled("title"), r"[\s\u00a0\u2000-\u200b\u202f\u3000]+", " ")))})
    unescaped = F.replace(F.replace("p_first", F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">"))
    marked = F.contains("p_first", F.lit("<")) | F.contains("p_first", F.lit("&"))
    rows = computed(rows, {"p_raw": F.when(marked, F.regexp_replace(unescaped, r"</?(?:b|i|u|em|strong|span|p|h[1-6]|a|font)>", "")).otherwise(F.col("p_first"))})
    named = F.trim(F.regexp_replace("p_raw", rf"\s*[|–—:·-]\s*(?:the )?(?:{names})(?:\.example)?\s*$|^(?:the )?(?:{names})(?:\.example)?\s*[|–—:·-]\s+", ""))
    has_name = F.lit(False)
    for site in sites:
        has_name = has_name | F.contains("p_raw", F.lit(site))
    return computed(rows, {"p_title": F.when(has_name, named).otherwise(F.trim("p_raw"))})


def passages(rows: DataFrame) -> DataFrame:
    """`rows` with its passages, null where blank: p_title, p_piece (what a title has between marks), p_status, p_error; and
    p_context: whether the page's address names anything that its title names, y or n.

    The address is `rollup_key` after its kind; `?` where there is no such column, the key is null or has no word.
    """
    out = _plain_titles(rows)
    own = F.lit("?")
    if "rollup_key" in rows.columns:
        words = lambda c: F.filter(F.split(c, r"[^\p{L}]+"), lambda w: F.length(w) >= 4)
        out = computed(out, {"p_words": words("p_raw"), "p_address": words(F.lower(F.regexp_replace("rollup_key", r"^[^:]*:", "")))})
        own = F.when(F.size("p_address") > 0, F.when(F.arrays_overlap("p_words", "p_address"), F.lit("y")).otherwise(F.lit("n"))).otherwise(own)
    pieces = F.when(F.col("p_title").rlike(r"[\[{<%]"), F.array_join(F.regexp_extract_all("p_title", F.lit(PIECES), 0), " "))
    out = computed(out, {"p_status": F.lower(F.trim(filled("http_status"))), "p_error": F.lower(F.trim(filled("error"))), "p_context": own, "p_piece": F.when(pieces != "", pieces)})
    return out.select(*rows.columns, "p_title", "p_piece", "p_status", "p_error", "p_context")


FIELDS = ("title", "piece", "status", "error")
#: What stands between marks within a title.
PIECES = r"\[[^\]]*\]|[$#%]?\{+[^}]*\}+|<[^>]*>|%\([^)]*\)[sd]"


def _unlikely(field: str, text: Column, context: Column) -> Column:
    """A title that names what its address names, or any other passage, if it has no mark of a placeholder."""
    if field == "piece":
        return F.lit(False)
    plain = ~text.rlike(r"[{}<>\[\]%$_@#]")
    return plain & (context == "y") if field == "title" else plain


class Model:
    """By field, log odds of every bucket and of a passage before its features are seen."""

    def __init__(self, weights: dict[str, np.ndarray], prior: dict[str, float]):
        self.weights, self.prior = weights, prior

    def posterior(self, field: str, features: Iterator) -> np.ndarray:
        sizes = np.fromiter((len(f) for f in features), np.int64, len(features))
        flat = np.concatenate(features) if sizes.sum() else np.zeros(0, np.int64)
        sums = np.add.reduceat(np.append(self.weights[field][flat] if field in self.weights else np.zeros(len(flat)), 0.0), np.minimum(np.cumsum(sizes) - sizes, len(flat))) if len(sizes) else np.zeros(0)
        sums[sizes == 0] = 0
        return 1 / (1 + np.exp(-np.clip(sums + self.prior.get(field, -9.0), -50, 50)))


def learn(rows: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model of the passages of `rows`: naive Bayes from trusted positives and the rest, by EM.

    Passages are counted first, so that a title with a third of all rows is one passage of that weight. Between rounds
    only the model, of BUCKETS pairs of sums at most, comes to the driver.
    """
    offers = [F.struct(F.lit(f).alias("field"), F.col(f"p_{f}").alias("text"), (F.col("p_context") if f == "title" else F.lit("?")).alias("context")) for f in FIELDS]
    long = rows.select(F.inline(F.filter(F.array(*offers), lambda o: o["text"] != "")))
    counted = long.groupBy("field", "text", "context").agg(F.count("*").cast("double").alias("n"))
    text, context = F.col("text"), F.col("context")
    of_field = lambda made: F.coalesce(*[F.when(F.col("field") == f, made(f)) for f in FIELDS])
    known = checkpoint(
        counted.select(
            "field",
            of_field(lambda f: _features(f, text, context if f == "title" else None)).alias("features"),
            F.when(F.col("field") == "piece", F.col("n")).otherwise(F.log1p("n")).alias("weight"),
            of_field(lambda f: trusted(f, text)).alias("trusted"),
            of_field(lambda f: _unlikely(f, text, context)).alias("unlikely"),
            F.when((context == "n") | (F.col("field") == "piece"), F.lit(0.5)).otherwise(F.lit(0.0)).alias("doubt"),
        )
    )
    model = None
    for _ in range(rounds):
        if model is None:
            share = F.when(F.col("trusted"), F.lit(1.0)).otherwise(F.col("doubt"))
        else:
            score = _score(known.sparkSession.sparkContext.broadcast(model))(F.col("field"), F.col("features"))
            share = F.when(F.col("trusted"), F.lit(1.0)).otherwise(score * F.when(F.col("unlikely"), F.lit(UNLIKELY)).otherwise(F.lit(1.0)))
        scored = computed(known, {"share": share})
        sums = scored.select("field", F.explode(F.concat(F.col("features"), F.array(F.lit(-1)))).alias("bucket"), (F.col("weight") * F.col("share")).alias("p"), (F.col("weight") * (1 - F.col("share"))).alias("n")).groupBy("field", "bucket").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
        model = _model(sums.toPandas())
    return model


def _model(sums: pd.DataFrame) -> Model:
    weights, prior = {}, {}
    for field, own in sums.groupby("field"):
        whole = own[own.bucket == -1].iloc[0]
        p, n = whole.p + 2 * SMOOTHING, whole.n + 2 * SMOOTHING
        prior[field] = float(np.log(p / n))
        own = own[own.bucket >= 0]
        rate = RATE_MASS * (own.p + own.n) / (p + n)
        weights[field] = np.zeros(BUCKETS)
        weights[field][own.bucket] = np.log((own.p + rate) / (p + RATE_MASS)) - np.log((own.n + rate) / (n + RATE_MASS))
    return Model(weights, prior)


def _score(model):
    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for field, features in batches:
            out = np.zeros(len(field))
            for name in field.unique():
                at = np.flatnonzero((field == name).to_numpy())
                out[at] = model.value.posterior(name, [features.iloc[k] for k in at])
            yield pd.Series(out)

    return score


def _score_rows(model):
    @F.pandas_udf("array<double>")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            out = np.zeros((len(columns[0]), len(FIELDS)))
            for k, (field, features) in enumerate(zip(FIELDS, columns, strict=True)):
                at = np.flatnonzero(features.notna().to_numpy())
                if len(at):
                    out[at, k] = model.value.posterior(field, [features.iloc[i] for i in at])
            yield pd.Series(list(out))

    return score


def with_residue(df: DataFrame, model: Model | None = None) -> DataFrame:
    """`df` (title, http_status, error) with `residue`: whether any field holds text that is no content of the page.

    Where `df` has `rollup_key`, the words of that address are evidence for a title that shares one and against the rest.
    Null and blank fields never count. A title of one or two plain words that could be a headline counts only with an
    HTTP status of 400 or more. Repeated rows get the same answer, an empty table stays empty, other columns stay (their
    names must not begin with `p_`). Without a `model` one is learnt from `df`.
    """
    rows = passages(df)
    model = model or learn(rows)
    features = [F.when(F.col(f"p_{f}") != "", _features(f, F.col(f"p_{f}"), F.col("p_context") if f == "title" else None)) for f in FIELDS]
    shared = df.sparkSession.sparkContext.broadcast(model)
    scored = computed(rows, {"p_score": _score_rows(shared)(*features)})
    found = {f: F.col("p_score")[k] > 0.5 for k, f in enumerate(FIELDS)}
    title = F.col("p_title")
    plain = title.rlike(r"^[\p{L}-]+(?: [\p{L}-]+)?$") & ~title.rlike(NEVER_HEADLINES)
    failed = F.coalesce(F.col("p_status").rlike(r"^[45]\d\d$"), F.lit(False))
    residue = found["piece"] | (found["title"] & F.coalesce(~plain | failed, F.lit(False))) | found["status"] | found["error"]
    return scored.withColumn("residue", residue).drop(*[c for c in scored.columns if c.startswith("p_")])


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched rows to be left out."""
    return with_residue(table(spark, sf_dir, "enriched").select("seq", "rollup_key", "title", "http_status", "error")).filter("residue").select("seq")


SQL: dict[str, str] = {}
QUERIES = {"p1_found": p1_found}

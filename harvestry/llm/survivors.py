"""Problem 2: one surviving record for each group of records, field by field.

Every field of every record becomes a long row with a vote: source trust times recency decay. Votes are summed per
normalised value, a field's winner is the value with the highest sum, taken by max_by in an aggregation with partial
results, and the winners are pivoted back to one row per group. Sums are decimals, so they don't depend on the order of rows.
Where the task states an order (`p2_found`), the value voted for is the row itself and the levels of trust are so far apart
that no recency outweighs one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import spelling_key, strip_blank
from ..operators.skew import attach_groups
from ..operators.timestamps import in_utc, parse_times, stated_instant
from ..session import checkpoint, computed, filled, table
from .formatting import _key_sql
from .residue import with_residue

#: Days after which a vote counts half.
HALF_LIFE_DAYS = 365.0
#: For a stated order: votes decay so slowly, seen from so late a day, that every moment of the 190 years before it counts for
#: more than a quarter; a missing moment counts for less than all of them and still for more than a quarter.
ORDER_HALF_LIFE, ORDER_DAY, ORDER_MISSING, LEVEL = 36525.0, "2100-01-01 00:00:00", 1.95 * 36525.0, 4.0
_SUM = "decimal(38,18)"


def unpivot(df: DataFrame, group: list[str], row: str, fields: dict[str, tuple[Column, Column, Column, Column, Column]]) -> DataFrame:
    """Long rows (`group`, field, value, row, trust, age_days, tie) from {field: (eligible, value, trust, age, tie)}.

    Rows that aren't eligible for a field give none for it; values come as text.
    """
    offers = [
        F.when(ok, F.struct(F.lit(f).alias("field"), value.cast("string").alias("value"), F.col(row).alias("row"), trust.cast("double").alias("trust"), age.cast("double").alias("age_days"), tie.cast("bigint").alias("tie")))
        for f, (ok, value, trust, age, tie) in fields.items()
    ]
    return df.select(*group, F.inline(F.filter(F.array(*offers), lambda o: o.isNotNull())))


def elect(long: DataFrame, group: list[str], fields: list[str], absent: Column | None = None, also: list[Column] | None = None) -> DataFrame:
    """One row per group with the winning value of each field; `absent` (else null) where a field has no candidate.

    One max_by per field over the same rows: tasks send one candidate per group and field whatever a group's size.
    """
    winners = [F.max_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, F.col("vote"))).alias(f) for f in fields]
    picked = long.groupBy(*group).agg(*winners, *(also or []))
    return picked if absent is None else picked.select(*group, *[F.coalesce(f, absent).alias(f) for f in fields])


def weighted_votes(long: DataFrame, group: list[str], half_life: float = HALF_LIFE_DAYS, rows_only: bool = False) -> DataFrame:
    """Long rows (`group`, field, value, vote) of one vote per normalised value: the sum of trust times recency decay.

    `long` is as `unpivot` gives it. Values that differ in letter case and blanks only are one; the spelling of the
    strongest single vote stands for it. The vote is a struct (total, best), best being the strongest single vote with its
    tie and the smallest row, so that ties are settled the same way every time. With `rows_only` the values are rows, which
    need no normalising.
    """
    weight = (F.col("trust") * F.pow(F.lit(2.0), -F.greatest(F.col("age_days"), F.lit(0.0)) / F.lit(half_life))).cast(_SUM)
    form = F.col("value") if rows_only else F.lower(F.regexp_replace(strip_blank(F.col("value")), r"\s+", " "))
    own = long.select(*group, "field", "value", form.alias("form"), F.struct(weight.alias("weight"), "tie", (-F.col("row")).alias("first")).alias("best"))
    summed = own.groupBy(*group, "field", "form").agg(F.sum("best.weight").cast(_SUM).alias("total"), F.max_by("value", "best").alias("value"), F.max("best").alias("best"))
    return summed.select(*group, "field", "value", F.struct("total", "best").alias("vote"))


CURATED = ["kind", "rollup_key", "url", "canonical_key", "host", "path", "first_seen_ts", "last_seen_ts", "member_url_count", "latest_status", "latest_mimetype"]


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """curated with `page_rollup` and `page_key`, the keys apart from formatting."""
    return computed(table(spark, sf_dir, "curated"), {"page_rollup": spelling_key(F.col("rollup_key")), "page_key": spelling_key(F.col("canonical_key"))})


def _short(key: Column | str) -> Column:
    """A key by its digest of 128 bits, for groups that only its rows are wanted of."""
    return F.unhex(F.md5(key))


def _moment(ts: Column) -> Column:
    """The time of a 14-digit stamp, else null."""
    return F.try_to_timestamp(F.when(ts.rlike(r"^\d{14}$"), ts), F.lit("yyyyMMddHHmmss"))


def _age(at: Column, day: Column | str = ORDER_DAY, missing: float = ORDER_MISSING) -> Column:
    """Days from `at` to `day`; `missing` where there is no time."""
    end = F.lit(day).cast("timestamp") if isinstance(day, str) else day
    return F.coalesce((F.unix_seconds(end) - F.unix_seconds(at)) / F.lit(86400.0), F.lit(missing))


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_rollup, title_seq): the enriched row whose title survives for each rollup key, which is given by its digest.

    Blank titles and residue (problem 1) don't stand; status 200 comes first, then the latest snapshot as an instant
    (none last), then the smallest seq.
    """
    flagged = with_residue(table(spark, sf_dir, "enriched").select("seq", "rollup_key", "title", "http_status", "error", "snapshot_timestamp"))
    rows = flagged.filter(~F.col("residue") & filled("title").isNotNull() & (strip_blank(F.col("title")) != "") & F.col("rollup_key").isNotNull())
    parsed = parse_times(rows.select("seq", "rollup_key", F.coalesce(F.trim("http_status") == "200", F.lit(False)).alias("ok"), "snapshot_timestamp"), "snapshot_timestamp")
    instant = F.coalesce(stated_instant(parsed), in_utc(F.col("t_local"), "UTC"), F.try_to_timestamp("t_date", F.lit("yyyy[-MM[-dd]]"))).cast("timestamp")
    keyed = parsed.select(_short(spelling_key(F.col("rollup_key"))).alias("page_rollup"), "seq", F.when(F.col("ok"), LEVEL).otherwise(1.0).alias("level"), _age(instant).alias("age"))
    long = unpivot(keyed, ["page_rollup"], "seq", {"title_seq": (F.lit(True), F.col("seq"), F.col("level"), F.col("age"), F.lit(0))})
    return elect(weighted_votes(long, ["page_rollup"], ORDER_HALF_LIFE, rows_only=True), ["page_rollup"], ["title_seq"])


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_rollup, page_key, first_seq, url_seq, seen_seq, count_seq) of every page with two or more curated rows.

    Keys are given by their digests. Every row votes for itself, with a trust of LEVEL to the power of its rank.
    """
    none, zero, seq = F.lit(0), F.lit(0.0), F.col("seq")
    seen, size = _age(_moment(F.col("last_seen_ts"))), F.coalesce(F.col("member_url_count"), none)
    complete = sum((filled(F.col(c).cast("string")).isNotNull().cast("int") for c in CURATED), start=none)
    trusted = F.coalesce((F.trim("latest_status") == "200") & (F.trim("latest_mimetype") == "text/html"), F.lit(False))
    rank = complete + F.when(trusted, F.lit(len(CURATED) + 1)).otherwise(none)
    fields = {
        "first_seq": (F.lit(True), seq, F.lit(1.0), zero, none),
        "url_seq": (F.lit(True), seq, F.pow(F.lit(LEVEL), rank), seen, size),
        "seen_seq": (filled("last_seen_ts").isNotNull(), seq, F.lit(1.0), seen, none),
        "count_seq": (F.col("member_url_count").isNotNull(), seq, F.col("member_url_count"), zero, none),
    }
    group = ["page_rollup", "page_key"]
    pages = _pages(spark, sf_dir).withColumns({c: _short(c) for c in group})
    votes = weighted_votes(unpivot(pages, group, "seq", fields), group, ORDER_HALF_LIFE, rows_only=True)
    return elect(votes, group, list(fields), also=[F.count_if(F.col("field") == "first_seq").alias("rows")]).filter("rows > 1").drop("rows")


def with_titles(pages: DataFrame, titles: DataFrame) -> DataFrame:
    """`pages` with the `titles` of their page_rollup, if any; a rollup key may have very many pages."""
    pages = checkpoint(pages)
    of_key = pages.groupBy("page_rollup").agg(F.count("*").alias("pages")).join(titles, "page_rollup", "left")
    return attach_groups(pages, of_key, ["page_rollup"], "pages", pages.count())


ROW_FIELDS = ["first_seq", "url_seq", "seen_seq", "count_seq"]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every page with two or more curated rows, the rows that its surviving fields come from."""
    joined = with_titles(page_rows(spark, sf_dir), page_titles(spark, sf_dir))
    return joined.select(*[F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")).alias(c) for c in [*ROW_FIELDS, "title_seq"]])


def p2_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`p2_found` without the titles, which no SQL can tell from residue."""
    return page_rows(spark, sf_dir).select(*[F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")).alias(c) for c in ROW_FIELDS])


RECORD_FIELDS = ["url", "host", "path", "first_seen_ts", "last_seen_ts", "member_url_count", "latest_status", "latest_mimetype"]


def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per page built from the values with the highest sums of trust times recency decay.

    Status 200 has a trust of 1, all else of 0.25; age is measured from the latest time in the tables, and a row without one
    is taken for ten years old. Titles are those of the enriched rows of the page, elected in the same way.
    """
    rows, enriched = _pages(spark, sf_dir), table(spark, sf_dir, "enriched")
    snapshot = _moment(F.trim("snapshot_timestamp"))
    latest = F.lit(max(filter(None, (d.agg(F.max(c)).first()[0] for d, c in ((rows, _moment(F.col("last_seen_ts"))), (enriched, snapshot)))), default=None)).cast("timestamp")
    trust = lambda c: F.when(F.trim(c) == "200", F.lit(1.0)).otherwise(F.lit(0.25))
    age, group = _age(_moment(F.col("last_seen_ts")), latest, 3650.0), ["page_rollup", "page_key"]
    fields = {c: (filled(F.col(c).cast("string")).isNotNull(), F.col(c), trust("latest_status"), age, F.lit(0)) for c in RECORD_FIELDS}
    records = elect(weighted_votes(unpivot(rows, group, "seq", fields), group), group, RECORD_FIELDS)
    titled = enriched.filter(F.col("rollup_key").isNotNull()).withColumn("page_rollup", spelling_key(F.col("rollup_key")))
    title = {"title": (filled("title").isNotNull() & (strip_blank(F.col("title")) != ""), strip_blank(F.col("title")), trust("http_status"), _age(snapshot, latest, 3650.0), F.lit(0))}
    titles = elect(weighted_votes(unpivot(titled, ["page_rollup"], "seq", title), ["page_rollup"]), ["page_rollup"], ["title"])
    return with_titles(records, titles).drop("pages")


_BLANK_SQL = r"[\s\x{0085}\x{00a0}\x{1680}\x{180e}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"


def _stripped_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_BLANK_SQL}+', ''), '{_BLANK_SQL}+$', '')"


def _filled_sql(c: str) -> str:
    return f"nullif(nullif(trim(cast({c} as varchar)), ''), '-')"


def _moment_sql(c: str) -> str:
    return f"try_strptime(case when regexp_full_match({c}, '[0-9]{{14}}') then {c} end, '%Y%m%d%H%M%S')"


def _records_sql() -> str:
    """The same votes in SQL: offers of each field, sums per normalised value, the best value of each field, joined again."""
    weight = "cast((case when trim({status}) = '200' then 1.0::double else 0.25::double end) * pow(2.0::double, -greatest(coalesce((epoch(latest) - epoch({at})) / 86400.0, 3650.0::double), 0.0::double) / 365.0::double) as decimal(38,18))"
    curated = weight.format(status="latest_status", at=_moment_sql("last_seen_ts"))
    titled = weight.format(status="http_status", at=_moment_sql("trim(snapshot_timestamp)"))
    offers = " union all ".join(f"select page_rollup, page_key, '{c}' as field, cast({c} as varchar) as value, seq, {curated} as weight from pages, clock where {_filled_sql(c)} is not null" for c in RECORD_FIELDS)
    return f"""with clock as (select greatest((select max({_moment_sql("last_seen_ts")}) from curated), (select max({_moment_sql("trim(snapshot_timestamp)")}) from enriched)) as latest),
        pages as (select *, {_key_sql("rollup_key")} as page_rollup, {_key_sql("canonical_key")} as page_key from curated),
        titles as (select {_key_sql("rollup_key")} as page_rollup, '' as page_key, 'title' as field, {_stripped_sql("title")} as value, seq, {titled} as weight from enriched, clock
            where rollup_key is not null and {_filled_sql("title")} is not null and {_stripped_sql("title")} <> ''),
        offers as ({offers} union all select * from titles),
        sums as (select page_rollup, page_key, field, lower(regexp_replace({_stripped_sql("value")}, '\\s+', ' ', 'g')) as form, sum(weight) as total,
            first(value order by weight desc, seq) as value, max(weight) as best, first(seq order by weight desc, seq) as row_seq from offers group by all),
        won as (select page_rollup, page_key, field, first(value order by total desc, best desc, row_seq) as value from sums group by all)
        select k.page_rollup, k.page_key, {", ".join(f"w.{c}" for c in RECORD_FIELDS)}, t.value as title
        from (select distinct page_rollup, page_key from pages) k
        left join (select page_rollup, page_key, {", ".join(f"max(case when field = '{c}' then value end) as {c}" for c in RECORD_FIELDS)} from won group by all) w using (page_rollup, page_key)
        left join (select page_rollup, value from won where field = 'title') t on t.page_rollup = k.page_rollup"""


_ROWS_SQL = f"""with a as (select seq, {_key_sql("rollup_key")} as r, {_key_sql("canonical_key")} as k, {_filled_sql("last_seen_ts")} as seen, coalesce(member_url_count, 0) as n, member_url_count as given,
        case when trim(latest_status) = '200' and trim(latest_mimetype) = 'text/html' then 1 else 0 end as ok, {" + ".join(f"({_filled_sql(c)} is not null)::int" for c in CURATED)} as complete from curated)
    select min(seq) as first_seq, first(seq order by ok desc, complete desc, seen desc nulls last, n desc, seq) as url_seq,
        coalesce(first(seq order by seen desc, seq) filter (where seen is not null), 0) as seen_seq, coalesce(first(seq order by given desc, seq) filter (where given is not null), 0) as count_seq
    from a group by r, k having count(*) > 1"""
SQL = {"p2_rows": _ROWS_SQL, "p2_records": _records_sql()}
QUERIES = {"p2_found": p2_found, "p2_rows": p2_rows, "p2_records": p2_records}

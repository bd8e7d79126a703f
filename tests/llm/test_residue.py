import os

import pytest

from harvestry.llm.residue import learn, passages, with_residue

CASES = [
    ("{{headline}}", "200", None, True), ("The Late Budget Of {name}", "200", None, True), ("Why [INSERT TEAM] Matters", "200", None, True), ("lorem ipsum dolor sit amet", "200", None, True), ("Page not found | Tallyboard", "200", None, True),
    ("Please enable JavaScript to view this page", "200", None, True), ("404 Not Found", "200", None, True), ("undefined", "200", None, True), ("<b>Are you a robot?", "200", None, True), ("Sign in to view this page", None, None, True),
    ("Gone", "410", None, True), ("Gone", "200", None, False), ("Access Denied", "403", None, True), ("Access Denied", None, None, False), ("Gone", "{{status}}", None, True),
    ("Page Not Found: The Lost Ballots Of Dibisese", "200", None, False), ("404 Ways To Lose Malohote", "404", None, False), ("The {Almost} Perfect Budget In Jemimebo", "200", None, False), ("[Updated] Air Quality In Placo", "200", None, False), ("Is 50% Off Rumodo Really Half?", "200", None, False),
    (None, "200", None, False), ("", "404", None, False), (" ", None, "HTTP 404 for snapshot", False), ("A Fine Title Of Town3", "200", "too many redirects", False), ("A Fine Title Of Town3", "200", "failed with %(code)d", True), ("A Fine Title Of Town4", "XXX", None, True), ("A Fine Title Of Town5", "503", "ReadTimeout after 600s", False),
    ("The Long Story Of A Budget In Town " * 3_000, "200", None, False), (None, None, None, False),
]
#: Titles that stand neither in the code nor in any table.
UNSEEN = [
    "Attention Required! | Cloudflare", "Checking your browser before accessing example.com", "Website is offline", "Domain for sale", "Maecenas faucibus mollis interdum", "Hello world! 1", "Your session has expired, start over", "We are upgrading our servers", "Whoops, looks like nothing lives here",
    "Unusual traffic has been detected from your network", "Database error: too many connections", "Kindly whitelist us in your ad blocker", "Fehler beim Laden der Seite", "Contenu indisponible pour le moment", "Powered by nginx on Ubuntu", "Nulla facilisi cras fermentum odio", "<%- pageHeading %> Town3", "{{ cms.seo.heading }}", "Welcome to %(host)s", "Why [insert your city here] Matters",
]
SCHEMA = "seq bigint, rollup_key string, title string, http_status string, error string, residue_of string"


def frame(spark):
    towns = ("Dibisese", "Malohote", "Jemimebo", "Placo", "Rumodo")
    good = [(f"The {a} {b} Of {c}ville{i}", f"article:{c.lower()}ville{i}-{b.lower()}", "200", None) for i, (a, b, c) in enumerate((a, b, c) for a in ("Late", "Rural", "Noisy", "Steep") for b in ("Trend", "Budget", "Index", "Record", "Share") for c in towns for _ in range(2))]
    good += [(f"{lead} In {c}", f"article:wp/{c.lower()}-trend-{k}", "200", e) for k in range(4) for c in towns for lead, e in (("Page Not Found: The Lost Ballots", None), ("The {Almost} Perfect Budget", None), ("[Updated] Air Quality", "no capture in range"), ("404 Ways To Lose", "too many redirects"), (f"What {k}0 Voters Said", "ReadTimeout after 600s"))]
    bad = [(t, f"article:page-{k}", s, None) for k, (t, s) in enumerate([("Page not found", "404"), ("Gone", "410"), ("403 Forbidden", "403"), ("Access Denied", "403"), ("Please enable JavaScript", "200"), ("The {{name}} Race", "200"), ("How ${team} Won", "200"), ("What [insert state] Said", "200")] * 3)]
    marks = [(None, "article:none", "200", e) for e in ("lorem ipsum dolor", "todo: error text", "{{error}}", "%s while fetching %s")] + [(None, "article:none", s, None) for s in ("{{status}}", "undefined", "200", "404", "503")]
    rows = [(i, None if t is None else "article:" + ("quiet-field" if r and not s == "XXX" and not e else t.lower().split()[-1].strip("?") if t.strip() else "x"), t, s, e, "x") for i, (t, s, e, r) in enumerate(CASES)]
    return spark.createDataFrame(rows + [(1000 + i, k, t, s, e, "x") for i, (t, k, s, e) in enumerate(good)] + [(5000 + i, k, t, s, e, "x") for i, (t, k, s, e) in enumerate(bad + marks)] + [rows[0]], SCHEMA)


@pytest.fixture(scope="module")
def model(spark):
    return learn(passages(frame(spark)))


def test_cases(spark):
    out = with_residue(frame(spark))
    assert out.columns == ["seq", "rollup_key", "title", "http_status", "error", "residue_of", "residue"]
    got = {}
    for r in out.collect():
        got.setdefault(r.seq, set()).add(r.residue)
    assert {i: got[i] for i in range(len(CASES))} == {i: {c[3]} for i, c in enumerate(CASES)}
    assert all(got[i] == {False} for i in got if 1000 <= i < 5000)


def test_titles_that_no_form_or_table_has(spark, small):
    folder = small.replace("sf0.001", "sf0.01")
    model = learn(passages(spark.read.parquet(f"{folder if os.path.isdir(folder) else small}/enriched.parquet")))
    rows = [(i, "article:wp/2014/05/narrow-budget-of-kasimoto", t, "200", None, "x") for i, t in enumerate(UNSEEN)]
    real = [(100 + i, f"article:wp/2014/05/{k}", t, "200", None, "x") for i, (k, t) in enumerate([("kasimoto-school-lunches", "School Lunches Are Costly In Kasimoto"), ("errors-of-gelonia", "Errors, Blocks And Scripts: Gelonia Explains"), ("wages-rise", "Wages Rise Sharply"), ("javascript-hiring", "JavaScript Hiring Slows")])]
    out = {r.seq: r.residue for r in with_residue(spark.createDataFrame(rows + real, SCHEMA), model).collect()}
    assert sum(out[i] for i in range(len(UNSEEN))) >= 0.9 * len(UNSEEN), [t for i, t in enumerate(UNSEEN) if not out[i]]
    assert not any(out[r[0]] for r in real), [r[2] for r in real if out[r[0]]]


def test_without_addresses_the_words_decide(spark, model):
    cases = [("This page does not exist", True), ("The Late Index Of Town3", False), ("How Rural Counties Changed The Budget Of Placo", False), ("Why {team} Lost", True), ("Sorry, page not found", True)]
    df = spark.createDataFrame([(i, t, "200", None) for i, (t, _) in enumerate(cases)], "seq bigint, title string, http_status string, error string")
    assert {r.seq: r.residue for r in with_residue(df, model).collect()} == {i: c[1] for i, c in enumerate(cases)}


def test_empty_table(spark):
    assert with_residue(frame(spark).filter("false")).count() == 0

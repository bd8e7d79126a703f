import random
from itertools import product

import numpy as np
import pytest

from harvestry.llm.labelled import labelled_sentences
from harvestry.llm.private import LABELS, MAY_HOLD_MAIL, PLAIN_TOKENS, TOKENS, find_private, private_items, redacted, trained

TEXT = "By Olivia Sabgatti\nMy cell is 346.555.0156, text me anytime. Write to glesdale AT mailbox dot example. The affidavit lists Dan Zarmura, 907 13 6282, 7742 3rd Terrace, Viboweyo. Precinct 1-71 reported late (order no. 954-85-9095)."


@pytest.fixture(scope="module")
def field():
    return trained()


def test_held_out_sentences(field):
    test = labelled_sentences(4, seed=12345)
    right = wrong = missed = 0
    for (_, marks), found in zip(test, find_private([t for t, _ in test], field), strict=True):
        a, b = {(s, k) for s, _, k in marks}, {(s, k) for s, _, k in found}
        right, wrong, missed = right + len(a & b), wrong + len(b - a), missed + len(a - b)
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.97


def test_viterbi_against_brute_force(field):
    rng = random.Random(1)
    words = ["By", "Olivia", "Sabgatti", ",", "907 13 6282", "12", "Elm", "St", "the"]
    for _ in range(20):
        rows = [field.row(rng.choice(words)) for _ in range(4)]
        emitted = field._emissions(np.array([rows]))[0]
        best, path = -1e18, None


        for labels in product(range(len(LABELS)), repeat=4):
            score = field.starts[labels[0]] + sum(emitted[t, x] for t, x in enumerate(labels)) + sum(field.moves[a, b] for a, b in zip(labels, labels[1:], strict=False))
            if score > best:
                best, path = score, labels
        assert tuple(field.decode([rows])[0]) == path


def test_batches_of_other_sizes_give_the_same(field):
    texts = [t for t, _ in labelled_sentences(1, seed=5)]
    together = find_private(texts, field)
    assert together == [find_private([t], field)[0] for t in texts]


def test_items_and_redaction(spark, field):
    texts = [TEXT, None, "", "  \n ", "nothing here", "x" * 60_000, "😀 " + TEXT, "1.1." * 10_000, TEXT]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id bigint, text string, kind string")
    found = {}
    for r in private_items(df, "doc_id", "text", field).collect():
        found.setdefault(r.doc_id, []).append((r.start_at, r.kind))
    expected = [(TEXT.index(s), k) for s, k in (("Olivia", "name"), ("346", "phone"), ("glesdale", "email"), ("Dan Z", "name"), ("907 13", "id_number"), ("7742", "address"))]
    assert {k: sorted(v) for k, v in found.items()} == {0: expected, 6: [(a + 2, k) for a, k in expected], 8: expected}
    out = {r.doc_id: r.text for r in redacted(df, "doc_id", "text", field).collect()}
    assert out[0].startswith("By [name]\nMy cell is [phone], text me anytime. Write to [email]. The affidavit lists [name], [id_number], [address]")
    assert out[1] is None and all(out[i] == texts[i] for i in (2, 3, 4, 5, 7))
    assert private_items(df.filter("false"), "doc_id", "text", field).count() == 0


def test_given_names_outside_the_list(field):
    text = "According to James Carter, the count was fair. We asked Wei Zhang and Fatima Hassan about it."
    assert [text[a:b] for a, b, k in find_private([text], field)[0] if k == "name"] == ["James Carter", "Wei Zhang", "Fatima Hassan"]
    assert find_private(["Is Polling Errors In Fipagawo Really Uneven?", "Small Donors Are Changing Sitego"], field) == [[], []]


def test_items_of_long_lines_wherever_they_stand(field):
    for n in range(44, 104, 3):
        text = "the ballot count in the county was late " * (n // 8) + "and " * (n % 8) + "It was Victoria F. Gravescura who first noticed that the count drifted. " + "the ballot count in the county was late " * 20
        assert [(text[a:b], k) for a, b, k in find_private([text], field)[0]] == [("Victoria F. Gravescura", "name")]


#: Sentences, given names and surnames that stand neither in the labelled table nor in any of the given tables.
UNSEEN = [
    ("The tenants were represented by {}, while {} spoke for the landlord.", ["Kwame Okafor", "Ingrid Svensson"]), ("{} scored twice before halftime.", ["Rajesh Patel"]), ("After the storm, {} rebuilt the bakery.", ["Hiroshi Tanaka"]), ("Questions were answered by {} yesterday.", ["Carlos Mendez"]),
    ("My neighbour {} found the wallet.", ["Fatima Hassan"]), ("I met {} and {} at the station.", ["Priya Raman", "Sarah Connor"]), ("Thanks go to {}, our oldest subscriber.", ["Percival Jefferies"]), ("“Never again,” muttered {}.", ["Maren Aldous"]), ("The prize went to {} this spring.", ["Leopold Whitmore"]),
    ("Later that evening {} phoned the police.", ["Alistair Blakely"]), ("For years {} collected stamps.", ["Cedric Marlowe"]), ("{} and {} are cousins.", ["Mei-Ling Chow", "Pablo Quintero"]), ("This essay was edited by {}.", ["Anneliese Vogt"]), ("Nurse {} filled in the chart.", ["Bronwyn Pugh"]),
    ("The letter was addressed to {}, her landlord.", ["Otis Fairweather"]), ("We spoke to {} about the closure.", ["Nadia Petrescu"]), ("{}, the goalkeeper, apologised.", ["Lukas Brandt"]), ("She married {} in 1987.", ["Edmund Hargrave"]), ("On Friday {} resigned.", ["Simone Marchetti"]), ("According to {} and {}, it rained.", ["Ayesha Malik", "Duncan MacLeod"]), ("Yesterday {} thanked the volunteers.", ["Björn Halvorsen"]), ("{} declined to comment.", ["Gwendolyn Achterberg"]),
]


def test_names_and_sentences_that_no_table_has(field):
    texts = [(frame.format(*names), names) for frame, names in UNSEEN]
    found = find_private([t for t, _ in texts], field)
    got = sum(n in [t[a:b] for a, b, k in items if k == "name"] for (t, names), items in zip(texts, found, strict=True) for n in names)
    assert got >= 0.9 * sum(len(names) for _, names in texts), [t for (t, n), i in zip(texts, found, strict=True) if len(i) < len(n)]


def test_other_items_that_no_table_has(field):
    text = "Priya Raman lives at 77 Sunset Strip, dial 0161 496 0123 or mail priya.raman@letters.example."
    assert [(text[a:b], k) for a, b, k in find_private([text], field)[0]] == [("Priya Raman", "name"), ("77 Sunset Strip", "address"), ("0161 496 0123", "phone"), ("priya.raman@letters.example", "email")]


def test_sentences_of_the_table_are_not_those_of_the_documents(spark, small):
    import re

    from harvestry.llm.labelled import TEMPLATES

    texts = "\n".join(r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect())
    pieces = [p.strip() for t in TEMPLATES for p in re.split(r"\{\w\d?\}", t)]
    assert [p for p in pieces if len(p) >= 24 and p in texts] == []


def test_long_runs_of_digits_and_words_take_linear_time(field):
    assert find_private(["1 " * 40_000 + ":", "a-" * 40_000, "x" * 100_000 + "@", "A" + " and A" * 20_000], field) is not None


def test_plain_lines_give_the_same_tokens():
    lines = ["It’s a co-op, isn’t it? 3rd-quarter a1-b2 x_y _ abc123 12-ab www.x.example/a http://y 2016-01-02 12:30 +1 (212) 555-0199 é-É ünder_score don’t5", *UNSEEN[0][1], "a" * 1000 + "1"]
    assert not any(MAY_HOLD_MAIL.search(x) for x in lines)
    assert all([m.span() for m in TOKENS.finditer(x)] == [m.span() for m in PLAIN_TOKENS.finditer(x)] for x in lines)

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harvestry.operators.packed import compound_pairs, packed_names, split_packed, unpack

COMPOUNDS = [("polls", "surveys"), ("news", "sports")]
CASES = {
    '["Folasade \\"Sade\\" M", "Rebecca C"]': ['Folasade "Sade" M', "Rebecca C"],
    '"QUILPIKOV, Victoria","Disa R",Samuel ​P': ["QUILPIKOV, Victoria", "Disa R", "Samuel ​P"],
    "Vandworth Centre for Polls & Surveys": ["Vandworth Centre for Polls & Surveys"],
    "Vandworth Centre for Polsl and Surveys": ["Vandworth Centre for Polsl and Surveys"],
    "News and Sports Network, Crevverro": ["News and Sports Network, Crevverro"],
    'By "VEYMURA, D." | "Crevverro News and Sports Network"': ["VEYMURA, D.", "Crevverro News and Sports Network"],
    "Jonathan O, and Timothy V": ["Jonathan O", "Timothy V"],
    "BY Marstead, E.": ["Marstead, E."],
    "F M,Thorngatti College": ["F M", "Thorngatti College"],
    '"Svetlana ""Lana"" O","Kata. P"': ['Svetlana "Lana" O', "Kata. P"],
    "“Frederick \"Fred\" O”; “Christopher H”; Nicolás J": ['Frederick "Fred" O', "Christopher H", "Nicolás J"],
    "Amadou B||Zachary K": ["Amadou B", "Zachary K"],
    "A B ;  ; C D ;": ["A B", "C D"],
    "X Y &amp; Z W": ["X Y", "Z W"],
    "A B with C D with E F": ["A B", "C D", "E F"],
    "Data Cooperative, K": ["Data Cooperative, K"],
    "Catherine Bo, HFES": ["Catherine Bo", "HFES"],
    "GREGORY I, and PRA": ["GREGORY I", "PRA"],
    "DEBORAH U,CUPL": ["DEBORAH U", "CUPL"],
    "DATA COOPERATIVE, BOUABAYO": ["DATA COOPERATIVE, BOUABAYO"],
    "A B (C, D), E F": ["A B (C, D)", "E F"],
    '"unbalanced, A B': ['"unbalanced', "A B"],
    None: [],
    "": [],
    " - ": [],
    ";;,|": [],
}


@pytest.mark.parametrize("text", list(CASES))
def test_names(text):
    assert packed_names(text, COMPOUNDS) == CASES[text]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \"'\\,;|", min_size=1, max_size=8).map(lambda s: "x" + s + "y"), min_size=1, max_size=5))
def test_json_round_trip(values):
    assert split_packed(json.dumps(values)) == values


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abc,;| ", min_size=1, max_size=8).map(lambda s: "x" + s + "y"), min_size=1, max_size=5), st.sampled_from([";", "|", ", ", "\t"]))
def test_quoted_round_trip(values, glue):
    assert split_packed(glue.join(f'"{v}"' for v in values)) == values


def test_unpack_keeps_rows_columns_and_positions(spark):
    df = spark.createDataFrame([(1, "A B; C D; A B", "x"), (2, "A B", "y"), (3, None, "z"), (1, "A B; C D; A B", "x")], "seq int, field string, pos_of string")
    out = unpack(df.withColumnRenamed("pos_of", "values_of_field"), "field", [], least=2)
    assert out.columns == ["seq", "field", "values_of_field", "pos", "item"]
    assert sorted((r.seq, r.pos, r.item) for r in out.collect()) == sorted([(1, 1, "A B"), (1, 2, "C D"), (1, 3, "A B")] * 2)
    assert sorted((r.seq, r.item) for r in unpack(df, "field", []).filter("seq = 2").collect()) == [(2, "A B")]
    assert unpack(df.filter("false"), "field", []).count() == 0


def test_long_field(spark):
    text = "; ".join(f"N{i} M" for i in range(20_000))
    assert unpack(spark.createDataFrame([(1, text)], "seq int, field string"), "field", []).count() == 20_000


def test_compound_pairs(spark):
    names = spark.createDataFrame([("A News and Sports Network",), ("B & C",), ("Plain",), (None,)], "name string")
    assert compound_pairs(names, "name") == [("b", "c"), ("news", "sports")]

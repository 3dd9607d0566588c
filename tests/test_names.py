"""Names of personal answers in the other answers of the same record."""

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyframe.operators.privacy import mask_names, mask_record_names
from tallyframe.sources.contract import Contract

CASES = [
    ("Anna Schmidt met ANNA, then schmidt's dog", ["Anna Schmidt"], "[NAME] met [NAME], then [NAME]'s dog"),
    ("Annabel and Joanna stay; Anna Anna go", ["Anna"], "Annabel and Joanna stay; [NAME] [NAME] go"),
    ("Éva Nagy-Kovács, éva", ["Éva Nagy-Kovács"], "[NAME], [NAME]"),
    ("a.b (x) [y] a.b", ["a.b (x)"], "[NAME] [y] a.b"),
    ("Li and Liv", ["Li Wu"], "Li and Liv"),
    ("cost \\E 5 $1", ["\\E"], "cost [NAME] 5 $1"),
    ("call 123 now", ["123"], "call 123 now"),
    ("nothing", [], "nothing"), ("nothing", None, "nothing"), (None, ["Anna"], None), ("", ["Anna"], ""), ("  Anna ", ["", " Anna ", None], "  [NAME] "),
]


@pytest.mark.parametrize("text, names, want", CASES)
def test_mask_names(spark, text, names, want):
    df = spark.createDataFrame([(text, names)], "text string, names array<string>")
    assert rows(df.select(mask_names(F.col("text"), F.col("names")).alias("out")))[0]["out"] == want


def test_only_the_names_of_the_same_record(spark):
    contract = Contract({"questions": [{"id": "name", "type": "text", "pii": True}, {"id": "phone", "type": "text", "pii": True}, {"id": "says", "type": "free_text"}]})
    data = [("r1", "name", "Jo Bloggs"), ("r1", "phone", "+1 555 123 4567"), ("r1", "says", "I, Bloggs, dial +1 555 123 4567"), ("r2", "says", "Bloggs wrote a@b.org"), ("r3", "name", None), ("r3", "says", None)]
    entries = spark.createDataFrame(data, "record_id string, qid string, value string")
    got = {r["record_id"]: r["value"] for r in rows(mask_record_names(entries, contract))}
    assert got == {"r1": "I, [NAME], dial [PHONE]", "r2": "Bloggs wrote [EMAIL]", "r3": None}
    assert mask_record_names(entries, Contract({"questions": [{"id": "says", "type": "free_text"}]})).count() == 6

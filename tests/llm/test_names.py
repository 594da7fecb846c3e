"""Inputs whose own columns have the names that operators add."""

from pyspark.sql import functions as F

import corpus_pipeline
from accesstally.llm import decontaminate, near_duplicates, secrets, toxicity
from accesstally.llm.text import unused
from tests.llm.test_operators import SMALL, awkward, plain

NAMES = ("found", "_found", "spans", "_spans", "gone", "_gone", "_found_id", "_found_key", "text_key", "secrets", "_at", "Key")


def test_columns_of_any_name_pass(spark):
    rows, passage, frame = awkward(spark)
    clash = frame.withColumns({n: F.lit(i) for i, n in enumerate(NAMES)})
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    per = secrets.by_document(secrets.scored(frame))
    for apply in (
        lambda d: decontaminate.clean(d, items),
        lambda d: decontaminate.without_spans(d, items),
        near_duplicates.keep_one,
        lambda d: secrets.redact(d, per, found=unused(d, "_found")).select(d.columns),
    ):
        got = apply(clash)
        assert got.columns == clash.columns
        assert plain(got, "doc_id", "text") == plain(apply(frame), "doc_id", "text")
    assert unused(clash, "Found") == "__Found"


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    clash = docs.withColumns({n: F.lit(i) for i, n in enumerate(NAMES)})
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, clash, SMALL).columns == clash.columns, name


def test_every_sign_becomes_a_voter(spark):
    """More signs than any fixed number of voters, each in a few documents of its own."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    signs = [f"{a}{b}{b}{a}" for a in letters for b in letters if a != b][:130]
    rows = [(f"plain words {i % 7} and more", 0) for i in range(3000)]
    rows += [(f"plain words and {sign} {k}", 1) for sign in signs for k in range(6)]
    texts = spark.createDataFrame(rows, "text string, toxic int")
    voters = toxicity.choose_voters(texts)
    assert all(any(sign == v or v.endswith("*") and sign.startswith(v[:-1]) for v in voters) for sign in signs)


def test_votes_of_many_different_words_take_linear_time(spark):
    voters = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    text = " ".join("".join(chr(97 + (i // 26**k) % 26) for k in range(5)) for i in range(200_000)) + " waa waa"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = toxicity.cast_votes(frame, voters).first()
    assert row.fired[0] == 0 and row.hits > 1

"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import pytest
from pyspark.sql import functions as F

from siftwell.llm.chat import format_chats
from siftwell.llm.exact_dedup import drop_exact_duplicates, exact_groups
from siftwell.llm.fingerprint import fingerprint_edits
from siftwell.llm.mixing import mix, mix_sources
from siftwell.llm.mixing_lm import lm_scores
from siftwell.llm.pieces import encode_documents, encode_texts
from siftwell.llm.quality import drop_low_quality, quality_scores
from siftwell.llm.runs import periodic_runs
from siftwell.llm.secrets import secret_spans
from siftwell.llm.simhash import drop_near_duplicates, simhash_groups
from siftwell.llm.substring_dedup import remove_repeats
from siftwell.llm.toxicity import toxicity_scores


def _labels(spark):
    rows = [(1, 0, 0), (2, 1, 0), (4, 1, None), (4, 0, 0), (None, 1, 0), (5, None, 0), (77, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


PER_ROW = {
    "fingerprint": lambda s, d: fingerprint_edits(d),
    "pieces": lambda s, d: encode_texts(d),
    "simhash": lambda s, d: simhash_groups(d),
    "quality": lambda s, d: quality_scores(d, _labels(s)),
    "mixing": lambda s, d: mix_sources(d),
    "exact": lambda s, d: exact_groups(d),
    "substring": lambda s, d: remove_repeats(d),
    "secrets": lambda s, d: secret_spans(d),
    "lm": lambda s, d: lm_scores(d, 50),
    "runs": lambda s, d: periodic_runs(d),
    "toxicity": lambda s, d: toxicity_scores(d, _labels(s)),
}
STAGES = {
    "quality": lambda s, d: drop_low_quality(d, _labels(s)),
    "exact": lambda s, d: drop_exact_duplicates(d),
    "near": lambda s, d: drop_near_duplicates(d),
    "mix": lambda s, d: mix(d),
}


@pytest.mark.parametrize("name", list(PER_ROW))
def test_one_row_per_document(spark, awkward, name):
    given = sorted(r[0] if r[0] is not None else -1 for r in awkward.select("doc_id").collect())
    rows = PER_ROW[name](spark, awkward).collect()
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in rows) == given


@pytest.mark.parametrize("name", list(PER_ROW))
def test_empty_table(spark, awkward, name):
    full = PER_ROW[name](spark, awkward)
    empty = PER_ROW[name](spark, awkward.limit(0))
    assert empty.columns == full.columns
    assert empty.count() == 0


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_keep_columns(spark, awkward, name):
    kept = STAGES[name](spark, awkward)
    assert kept.columns == awkward.columns
    assert 0 < kept.count() <= 2 * awkward.count()
    assert STAGES[name](spark, awkward.limit(0)).count() == 0


def test_exact_edges(spark, awkward):
    rows = drop_exact_duplicates(awkward).select("doc_id", "text").collect()
    texts = [r.text or "" for r in rows]
    assert len(texts) == len(set(texts))
    assert {r.doc_id for r in rows if (r.text or "") == ""} == {2}
    assert {r.doc_id for r in rows if r.text and r.text.startswith("A b")} == {8}
    kept = [r for r in exact_groups(awkward).collect() if r.kept]
    assert len(kept) == len(texts)


def test_encoded_documents_replace_clashing_columns(awkward):
    coded = encode_documents(awkward)
    assert coded.columns.count("ids") == 1 and coded.count() == awkward.count()
    assert coded.where("text IS NULL").select("n_ids").first()[0] == 0


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, part int, n int"
    rows = [
        (None, None, None, None, 1, 1), (1, 1, "user", "a", 1, 1), (1, 1, "user", "a", 2, 2),
        (1, None, "assistant", None, 1, 1), (2, 5, "system", "only", 1, 1), (3, 1, "bot", "<|x|>", 1, 1),
    ]
    turns = spark.createDataFrame(rows, schema)
    found = format_chats(turns).orderBy("conv_id", "seq").collect()
    by = {}
    for r in found:
        by.setdefault(r.conv_id, []).append((r.role, r.action))
    assert by[1] == [("user", "keep"), ("assistant", "keep")]
    assert by[2] == [("system", "keep"), ("user", "insert"), ("assistant", "insert")]
    assert by[3] == [("user", "relabel"), ("assistant", "insert")]
    assert by[None] == [("user", "relabel"), ("assistant", "insert")]
    assert "< |x|>" in "".join(r.rendered for r in found if r.conv_id == 3)
    assert format_chats(turns.where(F.lit(False))).count() == 0


def test_long_chat_and_empty_encode(spark, awkward):
    turns = [(1, k, ("user", "assistant")[k % 2], "word " * 4000, 1, 1) for k in range(60)]
    schema = "conv_id long, turn long, role string, text string, part int, n int"
    found = format_chats(spark.createDataFrame(turns, schema)).collect()
    assert len(found) == 60 and {r.action for r in found} == {"keep"}
    empty = encode_documents(awkward.limit(0))
    assert empty.count() == 0 and empty.columns == encode_documents(awkward).columns


def test_pipeline_of_no_documents(spark, awkward, tmp_path):
    import corpus_pipeline

    awkward.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    _labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() == 0 and {"doc_id", "text", "ids"} <= set(found.columns)


def test_rows_that_differ_in_maps_only(spark):
    rows = [(1, "a b", {"k": 2}), (1, "a b", {"k": 1}), (None, "c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>")
    assert sorted(r.m["k"] if r.m else 0 for r in drop_exact_duplicates(docs).collect()) == [0, 1]

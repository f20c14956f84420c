"""Queries of the subpackage against SQL, and the pipeline's stages one after another."""

import pytest

import corpus_pipeline
from labelforge.llm import ngram_join, substring
from labelforge.llm.queries import QUERIES, SQL
from labelforge.plans.check import compare, connect

from .data import frame, rows
from .test_pairs import components, without_repeats

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF), QUERIES[name], SQL[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() >= spark.read.parquet(f"{SF}/documents.parquet").count()


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        docs = spark.createDataFrame(out.collect(), docs.schema)
        counts.append(docs.count())
    assert counts[0] > counts[1] == counts[2] > counts[3] == counts[4] > 0
    assert docs.where("n_chars <> char_length(text)").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).select("doc_id").distinct().count() == counts[4]


def test_near_duplicates_stage(spark):
    table = rows()
    kept = corpus_pipeline.drop_near_duplicates(spark, frame(spark, table), SF)
    want = {i for i, _, c in components(table) if i == c and i is not None}
    assert {r.doc_id for r in kept.collect()} - {None} == want


def test_one_of_many_copies_comes_through(spark):
    """A third of a source's rows are copies of one text: the stages of lines and near duplicates leave one of them, whole."""
    text = "\n".join(f"the copied page has line {i} of its own" for i in range(6))
    table = [(i, text, "a") for i in range(20)] + [(20 + i, "menu\n" + " ".join(f"w{i}x{j}" for j in range(20)), "a") for i in range(40)]
    out = corpus_pipeline.drop_lines(spark, frame(spark, table), SF)
    out = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(out.collect(), out.schema), SF).collect()
    assert {r.doc_id: r.text for r in out} == {0: text} | {i: t.removeprefix("menu\n") for i, t, _ in table[20:]}


def test_substring_stage(spark):
    table = rows()
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_substrings(spark, frame(spark, table), SF).collect()}
    for i, _, gone, kept in without_repeats(table):
        if i is not None and gone:
            assert got[i] == kept


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_rows(spark, stage):
    f = corpus_pipeline.STAGES[stage][1]
    out = f(spark, frame(spark, rows()), SF)
    if stage < 4:
        assert out.columns == frame(spark, []).columns
    else:
        assert out.select("doc_id").distinct().count() == len({i for i, _, _ in rows()})
    assert f(spark, frame(spark, []), SF).count() == 0


def test_run_is_its_stages_one_after_another(spark):
    """Each stage's plain model on what the one before kept; the packing holds every token of the rest once."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from labelforge.llm import lines, quality

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = quality.classify(docs, labels).where("predicted = 1").select(docs.columns)
    table = [(r.doc_id, r.text, r.source) for r in lines.line_dedup(kept, distinct=True).collect()]  # held against SQL and cases of its own
    stay = {i for i, _, c in components(table) if i == c}
    table = [r for r in table if r[0] in stay]
    cut = {i: kept for i, _, gone, kept in without_repeats(table) if gone}
    texts = {i: cut.get(i, t) for i, t, _ in table}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.doc_tokens for r in got} == want
    assert sum(r.length for r in got) == sum(want.values()) and len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_defaults_are_the_contract():
    assert ngram_join.ngram_join.__defaults__[2:4] == (5, 75) and substring.substring_dedup.__defaults__[2] == 35

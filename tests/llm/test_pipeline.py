"""The stages one after the other, each against DuckDB or brute force over its own input."""

import brute
import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallyhouse.llm.queries import ORACLES


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Folder of each stage's input and of the last output."""
    root, docs = tmp_path_factory.mktemp("pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    folders = [f"{sf_dir}/documents.parquet"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        folders.append(f"{root}/{name}/*.parquet")
        docs = spark.read.parquet(f"{root}/{name}")
    return folders


def oracle(name, folder, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{folder}')")
    con.execute(f"create view benchmark as select * from read_parquet('{sf_dir}/benchmark.parquet')")
    return con.execute(ORACLES[name]).df()


def table(folder):
    return duckdb.sql(f"select * from read_parquet('{folder}')").df()


def test_names_and_columns(spark, stages, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "sharding"]
    columns = list(table(stages[0]).columns)
    assert all(list(table(folder).columns) == columns for folder in stages[:-1])
    assert list(table(stages[-1]).columns) == [*columns, "shard"]
    assert "pipeline" in entry.queries() and corpus_pipeline.ORACLE_SQL is None


def test_quality_rules_keep_what_the_rules_keep(stages, sf_dir):
    verdict = oracle("op1_quality_rules", stages[0], sf_dir)
    kept = table(stages[1])
    assert set(kept.doc_id) == set(verdict[verdict.kept].doc_id) and len(kept) == verdict.kept.sum() > 100
    removed = dict(zip(verdict.doc_id, verdict.n_words - verdict.n_removed, strict=True))
    assert all(len(brute.words(t)) == removed[d] and n == len(t) for d, t, n in zip(kept.doc_id, kept.text, kept.n_chars, strict=True))


def test_one_of_each_group_stays(stages, sf_dir):
    found = oracle("op3_jaccard_join", stages[1], sf_dir)
    assert sorted(table(stages[2]).doc_id) == sorted(set(found.component_id))


def test_contaminated_documents_go(stages, sf_dir):
    found = oracle("op9_decontamination", stages[2], sf_dir)
    assert sorted(table(stages[3]).doc_id) == sorted(found[~found.contaminated].doc_id) and found.contaminated.any()


def test_the_mix_takes_its_words(stages, sf_dir):
    want = oracle("op8_mixing", stages[3], sf_dir)
    mixed = table(stages[4])
    mixed["words"] = [len(brute.words(t)) for t in mixed.text]
    taken = mixed.groupby("doc_id").words.sum()
    want = want[want.taken > 0].set_index("doc_id").taken
    assert (taken.sort_index() == want.sort_index()).all() and len(taken) == len(want)
    whole = dict(zip(table(stages[3]).doc_id, table(stages[3]).text, strict=True))
    # Every text is its document or one piece of it, line breaks and all.
    cut = [(d, t) for d, t in zip(mixed.doc_id, mixed.text, strict=True) if t != whole[d]]
    assert cut and all(t in whole[d] for d, t in cut)
    assert any("\n" in t for _, t in cut) and all(t.strip(" \t\n\r\x0b\x0c") == t for _, t in cut)


def test_shards_follow_the_id(stages):
    before, after = table(stages[4]), table(stages[5])
    assert sorted(zip(before.doc_id, before.text, strict=True)) == sorted(zip(after.doc_id, after.text, strict=True))
    assert after.groupby("doc_id").shard.nunique().max() == 1 and set(after.shard) <= set(range(16))


def test_run_gives_the_same_rows(spark, stages, sf_dir):
    rows = [tuple(r) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "text", "shard").collect()]
    want = table(stages[5])
    assert sorted(rows) == sorted(zip(want.doc_id, want.text, want.shard, strict=True))

import base64

import corpus_pipeline
import duckdb
import edges
import public_tokenizers
import pytest
import tiktoken
from folioflow.llm import queries

NAMES = ["quality_rules", "near_duplicates", "decontamination", "personal_data", "tokens"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    item = edges.prose(501, 40)
    rows = [(i, edges.prose(i, 80), "en", "a", 1) for i in range(150)]
    rows += [(1000 + i, edges.prose(i, 80), "en", "a", 1) for i in range(20)]  # copies
    rows += [(2000, f"{edges.prose(700, 30)} {item} {edges.prose(701, 30)}", "en", "b", 1)]
    rows += [(2001, f"{edges.prose(702, 60)} write to me@example.com now", "en", "b", 1)]
    rows += [(2002, "short", "en", "b", 1), (2003, " ".join(w + "###" for w in edges.prose(703, 90).split()), "en", "b", 1)]
    spark.createDataFrame(rows, edges.SCHEMA + ", n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_run_takes_out_what_was_planted(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(found) == {*range(150), 2001}
    with open(public_tokenizers.path(queries.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert theirs.decode(found[2001].ids) == f"{edges.prose(702, 60)} write to <email> now"
    assert all(theirs.decode(found[i].ids) == edges.prose(i, 80) for i in range(150))


def test_stages_keep_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name


def test_edge_rows(spark, sf_dir):
    docs = edges.clashing(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs_out = stage(spark, docs, sf_dir)
        assert docs_out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, sf_dir).count() == len(edges.ROWS)
    assert last(spark, docs.limit(0), sf_dir).count() == 0


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_queries_against_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    result = con.execute(queries.ORACLE[name])
    names = [d[0] for d in result.description]
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(names)
    assert edges.rows(got.select(*names)) == sorted(result.fetchall(), key=repr)


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 11))

"""The pipeline's stages on their own inputs, the registered queries, and their
SQL on the smallest tables."""

import os
import shutil

import duckdb
import pytest

import corpus_pipeline as P
from hirescope.llm import jaccard
from hirescope.llm.oracle import SQL
from hirescope.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES) and [n for n, _ in P.STAGES] and len(P.STAGES) == 5


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name, tmp_path):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    QUERIES[name](spark, SF).write.parquet(str(tmp_path / "got"))
    con.execute(f"CREATE TABLE got AS SELECT * FROM '{tmp_path}/got/*.parquet'")
    con.execute(f"CREATE TABLE want AS {SQL[name]}")
    columns = ", ".join(sorted(c[0] for c in con.execute("DESCRIBE want").fetchall()))
    assert columns == ", ".join(sorted(c[0] for c in con.execute("DESCRIBE got").fetchall()))
    for a, b in (("got", "want"), ("want", "got")):
        assert con.execute(f"SELECT count(*) FROM (SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b})").fetchall() == [(0,)]
    assert con.execute("SELECT count(*) > 0 FROM want").fetchall() == [(True,)]


def test_stages_take_effect(spark, tmp_path):
    prose = {i: " ".join(f"word{(i * 37 + k * k) % 997}" for k in range(120)) for i in range(6)}
    rows = [(i, prose[i], "en" if i % 2 else "de") for i in range(6)]
    near = prose[0].split(" ")
    near[60] = "changed"
    repeated = "this very line stands in two documents and stays in one"
    rows += [(10, " ".join(near), "en"), (11, None, "en"), (12, "123 !!", "en"), (13, prose[1], "en"),
             (14, repeated + "\n" + prose[2][::-1], "en"), (15, repeated + "\n" + prose[3][::-1], "en"), (16, "start " + " ".join(f"leak{k}" for k in range(12)) + " end", "en")]
    docs = spark.createDataFrame([(i, t, la, "s", None if t is None else len(t)) for i, t, la in rows], "doc_id long, text string, lang string, source string, n_chars long")
    sf = str(tmp_path)
    spark.createDataFrame([(1, " ".join(f"LEAK{k}" for k in range(12)))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    kept = P.near_duplicate_stage(spark, docs, sf)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 11, 12, 14, 15, 16] and kept.columns == P.COLUMNS
    want = {r.doc_id for r in jaccard.near_duplicates(docs).collect() if r.doc_id == r.component_id}
    assert {r.doc_id for r in kept.collect()} == want

    cut = {r.doc_id: r for r in P.line_stage(spark, docs, sf).collect()}
    assert 13 not in cut and cut[14].text.startswith("this very line") and not cut[15].text.startswith("this very line")
    assert cut[15].n_chars == len(cut[15].text) and cut[11].text is None and cut[0].text == prose[0]

    clean = P.decontamination_stage(spark, docs, sf)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _, _ in rows if i != 16) and clean.columns == P.COLUMNS

    known = P.language_stage(spark, docs, sf)
    assert not {11, 12} & {r.doc_id for r in known.collect()} and known.columns == P.COLUMNS
    unknown = docs.selectExpr("doc_id", "text", "cast(null as string) as lang", "source", "n_chars")
    assert P.language_stage(spark, unknown, sf).count() == len(rows)

    encoded = P.encoding_stage(spark, docs, sf)
    assert encoded.count() == len(rows) and encoded.where("round_trip").count() == len(rows) - 1

    for _, stage in P.STAGES:
        assert stage(spark, docs.where("false"), sf).count() == 0


def test_run_applies_all_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = P.run(spark, SF)
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    assert 0 < len(ids) <= docs.count() and ids <= {r.doc_id for r in docs.select("doc_id").collect()}
    empty = tmp_path / "sf"
    os.makedirs(empty)
    docs.where("false").write.parquet(str(empty / "documents.parquet"))
    shutil.copy(f"{SF}/benchmark.parquet", empty / "benchmark.parquet")
    assert P.run(spark, str(empty)).count() == 0


def test_entry_works_without_the_subpackage(tmp_path):
    """A copy without corpus_pipeline.py and the two folders still imports."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/hirescope", tmp_path / "hirescope", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; n = e.queries(); assert 'role_demand' in n and not any(x.startswith('op') or x == 'pipeline' for x in n); print('FINE')"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "FINE" in got.stdout, got.stderr[-2000:]


def test_stages_remove_rows_not_ids(spark, tmp_path):
    prose = [" ".join(f"w{(i * 37 + k * k) % 997}x{i}" for k in range(60)) for i in range(6)]
    leak = "start " + " ".join(f"leak{k}" for k in range(12)) + " end"
    near = prose[3].replace("w", "v", 1)
    rows = [(1, prose[0]), (1, prose[0]), (1, prose[0]),  # a file ingested again
            (None, prose[1]), (None, prose[1]), (7, prose[1]),  # copies without an id
            (None, prose[2]), (None, prose[2]),
            (4, prose[3]), (9, near), (9, prose[4]),  # a clean row with the id of a near copy
            (None, None), (None, None), (12, ""), (12, ""),  # nothing to compare: no copies of each other
            (20, leak), (20, prose[5]), (None, leak)]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    sf = str(tmp_path)
    spark.createDataFrame([(1, " ".join(f"LEAK{k}" for k in range(12)))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    def held(df):
        return sorted([(r.doc_id, r.text) for r in df.collect()], key=str)

    once = [(1, prose[0]), (7, prose[1]), (None, prose[2]), (4, prose[3]), (9, prose[4]), (None, None), (None, None), (12, ""), (12, ""), (20, leak), (20, prose[5])]
    assert held(P.near_duplicate_stage(spark, docs, sf)) == sorted(once, key=str)
    assert held(P.decontamination_stage(spark, docs, sf)) == sorted([r for r in rows if r[1] != leak], key=str)


def test_encoding_workers_keep_few_chunks(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(P.nbest, "segmented", lambda docs, **how: asked.append(how) or docs)
    P.encoding_stage(spark, None, "")
    assert 0 < asked[0]["memo"] < P.nbest.MEMO // 4

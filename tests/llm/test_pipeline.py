import os

import pytest

import corpus_pipeline as pipeline
from orderlens.llm import queries as registered

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_stages_decide_and_keep_the_columns(session):
    import duckdb
    import sentencepiece
    import public_tokenizers
    from test_decontamination import brute_force as leaks
    from test_jaccard_join import brute_force as groups
    from test_quality_rules import measures
    from test_suffix_dedup import brute_force as repeated

    docs = session.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(pipeline.STAGES)
    kept = {r["doc_id"]: r for r in stages["quality_rules"](session, docs, SF_DIR).collect()}
    rejected = {r["doc_id"] for r in registered.op3_quality_rules(session, SF_DIR).where("NOT kept").collect()}
    assert set(kept) == set(texts) - rejected and rejected
    assert all(measures(r["text"])[0] >= 50 for r in kept.values())

    frame = session.createDataFrame([*kept.values()], docs.schema)
    one = {r["doc_id"]: r for r in stages["jaccard_join"](session, frame, SF_DIR).collect()}
    assert set(one) == {c for _, c in groups([(i, r["text"]) for i, r in kept.items()]).values()}

    frame = session.createDataFrame([*one.values()], docs.schema)
    cut = {r["doc_id"]: r for r in stages["suffix_dedup"](session, frame, SF_DIR).collect()}
    expected = repeated([(i, r["text"]) for i, r in one.items()], 50)
    assert {i: r["text"] for i, r in cut.items()} == {i: e[-1].decode(errors="ignore") for i, e in expected.items()}
    assert all(r["n_chars"] == len(r["text"]) and r["lang"] == one[i]["lang"] for i, r in cut.items())

    frame = session.createDataFrame([*cut.values()], docs.schema)
    items = duckdb.sql(f"select item_id, text from '{SF_DIR}/benchmark.parquet'").fetchall()
    clean = {r["doc_id"]: r for r in stages["decontamination"](session, frame, SF_DIR).collect()}
    leaked = {d for d, *_ in leaks([(i, r["text"]) for i, r in cut.items()], items)}
    assert set(clean) == set(cut) - leaked

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pipeline.PIECES))
    final = {r["doc_id"]: r for r in pipeline.run(session, SF_DIR).collect()}
    assert set(final) == set(clean)
    assert all(final[i]["ids"] == library.encode(r["text"]) and final[i]["round_trip"] for i, r in clean.items())


def test_stages_take_empty_tables(session):
    docs = session.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        after = stage(session, docs, SF_DIR)
        assert after.count() == 0
        assert name == "sentence_pieces" or after.columns == docs.columns


@pytest.mark.parametrize("name", registered.oracle_sql())
def test_query_equals_sql(session, name):
    import duckdb

    connection = duckdb.connect()
    for table in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{table}'")
    frame = registered.queries()[name](session, SF_DIR)
    names = sorted(frame.columns)
    result = connection.execute(registered.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    order = [columns.index(c) for c in names]
    expected = sorted(repr(tuple(row[i] for i in order)) for row in result.fetchall())
    assert sorted(repr(tuple(r)) for r in frame.select(*names).collect()) == expected


def test_queries_name_every_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registered.queries()) == [*range(1, 14)]

from pyspark.sql import functions as F

from orderlens.llm import decontamination as op

ITEM = "the quick brown fox jumps over the lazy dog and then runs far away into dark green woods"


def brute_force(docs, items):
    import regex

    def shingles(text):
        own = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
        return {tuple(own[k : k + 5]) for k in range(len(own) - 4)}

    out = set()
    for d, text in docs:
        for i, item in items:
            need, have = shingles(item), shingles(text)
            if need and 100 * len(need & have) >= 80 * len(need):
                out.add((d, i, len(need & have), len(need)))
    return out


def test_equals_brute_force_at_the_threshold(session, docs):
    own = ITEM.split()
    noise = " ".join(f"n{k}" for k in range(3000))
    rows = [(k, f"{noise} {' '.join(own[k:])}") for k in range(len(own))]
    rows += [(100 + k, f"{' '.join(own[: len(own) - k])} {noise}") for k in range(len(own))]
    rows += [(200 + k, " ".join([*own[:k], "changed", *own[k + 1 :]])) for k in range(len(own))]
    rows += [(300, ITEM.upper().replace(" ", ", ")), (301, None), (302, ""), (303, "the quick"), (300, ITEM), (None, ITEM)]
    items = [(1, ITEM), (2, " ".join(own[:9])), (3, "too short item"), (4, None), (1, ITEM), (5, "éa éb éc éd éé")]
    table = session.createDataFrame(items, "item_id long, text string")
    found = {tuple(r) for r in op.leaks(docs(rows), table, ["doc_id"]).select("doc_id", "item_id", "n_shared", "n_shingles").collect()}
    assert found == brute_force(rows, items) and len(found) > 20
    clean = op.clean(docs(rows), table)
    assert clean.columns == docs([]).columns
    leaked = {d for d, *_ in found}
    texts = {t for d, t in rows if d in leaked}
    assert sorted(map(str, (r["doc_id"] for r in clean.collect()))) == sorted(str(d) for d, t in rows if t not in texts)


def test_slices_and_empty_tables(session, docs, monkeypatch):
    monkeypatch.setattr(op, "SLICE_ITEMS", 2)
    items = session.createDataFrame([(k, f"{ITEM} {k}") for k in range(7)], "item_id long, text string")
    rows = docs([(1, f"{ITEM} 3"), (2, "nothing of the kind is in this text")])
    assert op.leaks(rows, items, ["doc_id"]).count() == 7
    assert op.leaks(rows, items.limit(0), ["doc_id"]).count() == 0 and op.clean(rows, items.limit(0)).count() == 2
    assert op.leaks(docs([]), items, ["doc_id"]).count() == 0 and op.clean(docs([]), items).count() == 0


def test_signatures_leave_no_room_for_a_miss(session):
    items = session.range(1, 300).select(
        F.col("id").alias("item_id"),
        F.array_join(F.transform(F.sequence(F.lit(1), F.col("id") + 4), lambda k: F.concat(F.lit("w"), k.cast("string"))), " ").alias("text"),
    )
    for row in op.signatures(items).collect():
        assert row["n_shingles"] == row["item_id"] and row["n_shingles"] <= 2 ** row["size_class"]
        assert len(row["signature"]) >= row["n_shingles"] - -(-80 * row["n_shingles"] // 100) + 1


def test_main_path_is_native(session, docs):
    items = session.createDataFrame([(1, ITEM)], "item_id long, text string")
    plan = op.leaks(docs([(1, ITEM)]), items, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_a_long_item_is_sent_as_its_hashes(session, docs, monkeypatch):
    """20 000 words, and slices smaller than its signature; the document holds four fifths and is verified once."""
    sent = []
    monkeypatch.setattr(op, "SLICE_PROBES", 2_000)
    monkeypatch.setattr(op.F, "broadcast", lambda df, plain=F.broadcast: sent.append(df) or plain(df))
    own = [f"w{k}" for k in range(20_000)]
    items = session.createDataFrame([(1, " ".join(own)), (1, ITEM), (None, ITEM)], "item_id long, text string")
    rows = [(1, " ".join(own[:16_100])), (2, " ".join(own[:15_900])), (3, " ".join(own[3_950:])), (4, ITEM), (4, ITEM), (5, " ".join(own[:16_100]))]
    found = sorted((r["doc_id"], r["item_id"] or 0, r["n_shared"], r["n_shingles"]) for r in op.leaks(docs(rows), items, ["doc_id"]).collect())
    long, short = 19_996, len(ITEM.split()) - 4
    assert found == [(1, 1, 16_096, long), (3, 1, 16_046, long), (4, 0, short, short), (4, 1, short, short), (5, 1, 16_096, long)]
    probes = [df for df in sent if "need" in df.columns]
    assert len(probes) >= 3 and {c for df in probes for c in df.columns} == {"item", "need", "__hash"}
    assert sum(df.count() for df in probes) < 7_000 and max(df.count() for df in probes) < 3_000


def test_names_that_clash(session, docs):
    items = session.createDataFrame([(7, ITEM, "x")], "item_id long, text string, n_shared string")
    rows = docs([(1, ITEM)]).withColumnRenamed("lang", "n_shared").withColumnRenamed("source", "item_id")
    found = op.leaks(rows, items, ["doc_id", "n_shared", "n_tokens", "item_id"])
    assert found.columns == ["doc_id", "n_tokens", "item_id", "n_shared", "n_shingles"] and found.first()["item_id"] == 7
    assert op.clean(rows.withColumn("__k1", F.lit(1)), items).count() == 0

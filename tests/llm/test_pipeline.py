"""The pipeline's stages on small tables: contracts between stages, planted cases, corner cases."""

import random

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rnd, n):
    return " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(3, 8))) for _ in range(n)) + "."


def tables(spark, folder, rows):
    rnd = random.Random(0)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    item = prose(random.Random(99), 30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return item, rnd


def test_stages_take_effect(spark, out):
    rnd = random.Random(3)
    clean = [prose(rnd, 80) for _ in range(20)]
    near = clean[0].split(" ")
    near[40] = "changed"
    item = prose(random.Random(99), 30)
    shared = prose(rnd, 55)
    texts = clean + [" ".join(near[:20] + ["x"] + near[20:]), clean[1], prose(rnd, 40) + " " + item, prose(rnd, 30) + "\n" + shared,
                     prose(rnd, 30) + "\n" + shared, None, ""]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    tables(spark, out, rows)
    docs = spark.read.parquet(f"{out}/documents.parquet")
    seen = []
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, out)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", "), name
        seen.append({r.doc_id: r.text for r in docs.collect()})
    quality, lines, unique, kept = seen
    assert set(range(20)) <= set(quality)
    assert 21 not in lines and shared in lines[23] and shared not in lines[24]
    assert 20 not in unique and set(range(20)) <= set(unique)
    assert 22 not in kept and set(range(20)) <= set(kept)
    final = P.run(spark, out).collect()
    assert {r.doc_id for r in final} == set(kept)


def test_near_duplicate_stage_keeps_a_repeated_row_once(spark, out):
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (None, "a b c d e f", "en", "s", 1)], SCHEMA)
    assert sorted(str(r.doc_id) for r in P.near_duplicates(spark, docs, out).collect()) == ["1", "None"]


def test_near_duplicate_stage_keeps_other_texts_of_one_id(spark, out):
    rows = [(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "t", 1), (1, "u v w x y z", "en", "s", 1), (1, None, "en", "s", 1), (2, "k l m n o p", "en", "s", 1)]
    found = [sorted(map(tuple, P.near_duplicates(spark, spark.createDataFrame(r, SCHEMA).repartition(n), out).collect()), key=str)
             for r, n in ((rows, 1), (rows[::-1], 5))]
    assert found[0] == found[1]
    assert sorted((r[0], str(r[1])) for r in found[0]) == [(1, "None"), (1, "a b c d e f"), (1, "u v w x y z"), (2, "k l m n o p")]


def test_empty_documents(spark, out):
    tables(spark, out, [])
    assert P.run(spark, out).count() == 0

"""The pipeline's stages by their effects, each against its own input, and the whole by its parts."""


import corpus_pipeline
from llm_cases import SF_DIR, SCHEMA, texts_of
from test_exact_dedup import ASCII
from test_near_dup import expected as near_expected
from test_pii import base
from test_tokens import check_packing

from limitlens.llm import toxicity
from limitlens.llm.tables import keep, table


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_and_run(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "personal_data", "packing"]
    docs = table(spark, SF_DIR, "documents")
    before = rows_of(docs)
    results = []
    for name, stage in corpus_pipeline.STAGES:
        out = keep(stage(spark, docs, SF_DIR), f"test-{name}")
        if name != "packing":
            assert out.columns == docs.columns
            assert out.schema == docs.schema
        docs = out
        results.append(out)
    toxic, exact, near, personal, packed = results

    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity(
        table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")).collect()}
    one = rows_of(toxic)
    assert sorted(one) == sorted(r for r in before if scores[r[0]] < 0.5)

    two = rows_of(exact)
    last = {}
    for doc_id, text in sorted(one):
        last[text.translate(ASCII)] = (doc_id, text)
    assert sorted(two) == sorted(last.values())

    three = rows_of(near)
    kept = {eval(r)[0] for r in near_expected(two, 5, 80) if eval(r)[3]}
    assert sorted(three) == sorted(r for r in two if r[0] in kept)

    texts = dict(three)
    for r in personal.collect():
        assert (r["text"] == texts[r["doc_id"]]) == (not base(texts[r["doc_id"]])[1])
        assert not base(r["text"])[1] and r["n_chars"] == len(r["text"])
    assert personal.count() == len(three)

    check_packing(packed.collect(), rows_of(personal))
    found = sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
    assert found == sorted(map(tuple, packed.collect()))


def test_odd_documents_pass_every_stage(spark):
    rows = [
        (1, "Copy me."), (2, "copy ME."), (None, None), (3, ""), (4, "x " * 5000), (5, "mail a@b.co"), (5, "mail a@b.co"),
        (6, "same id"), (6, "another text"), (None, "no id"),
    ]
    docs = spark.createDataFrame([(i, t, None, None, None, 0.1, "extra") for i, t in rows], SCHEMA)
    sizes = []
    for _, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, SF_DIR), "odd")
        sizes.append(docs.count())
    assert sizes[:4] == [10, 7, 7, 7]
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        empty = keep(stage(spark, empty, SF_DIR), "empty")
        assert empty.count() == 0


def test_column_names_that_begin_with_an_underscore(spark):
    names = ["_id", "_doc", "_own", "_digest", "_text", "_score", "_first", "_component", "_label", "_digest_kept", "a.b"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    rows = [(1, "Copy me. mail a@b.co"), (2, "copy ME. mail a@b.co"), (None, None), (3, "other words here")]
    docs = spark.createDataFrame([(i, t, *names) for i, t in rows], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = keep(stage(spark, docs, SF_DIR), "clash")
        assert docs.columns == ["doc_id", "text", *names] and [tuple(r)[2:] for r in docs.collect()] == [tuple(names)] * docs.count()
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["2", "3", "None"]
    assert corpus_pipeline.pack_sequences(spark, docs, SF_DIR).count() == 3


def test_near_copies_without_an_id_or_with_a_repeated_one(spark):
    words = [f"w{i}" for i in range(60)]
    near = lambda n: " ".join([*words, f"end{n}"])
    rows = [(None, near(1)), (None, near(2)), (None, "alone and without an id"), (7, near(3)), (7, "another text of the same id"), (9, near(4)), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, SF_DIR).collect()}
    assert found == {rows[2], rows[3], rows[4], rows[6]}
    unnamed = spark.createDataFrame([r for r in rows if r[0] is None], "doc_id long, text string")
    left = [r.text for r in corpus_pipeline.drop_near_copies(spark, unnamed, SF_DIR).collect()]
    assert len(left) == 3 and sum(t in (near(1), near(2)) for t in left) == 1

import corpus_pipeline
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the of and that with this from have not which".split(), "fr": "le la les des que dans pour avec qui nous".split()}


def test_stages(spark, tmp_path):
    import random

    r = random.Random(3)
    rows = []
    for i in range(120):
        lang = r.choice(["en", "fr"])
        rows.append((i, "\n".join(" ".join(r.choices(WORDS[lang], k=15)) + f" {i}x{k}." for k in range(6)), lang, f"s{i % 3}", 0))
    banner = "This banner stands on top of many documents."
    rows = [(i, f"{banner}\n{t}", lang, s, n) for i, t, lang, s, n in rows]
    rows += [(500, rows[5][1], "en", "s1", 0), (501, rows[6][1] + " tail", "en", "s1", 0), (502, "123 456", "en", "s1", 0), (503, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out, ids = docs, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        ids.append({x["doc_id"] for x in out.select("doc_id").distinct().collect()})
    language, lines, near, mixed, packed = ids
    assert {502, 503}.isdisjoint(language) and {*range(120), 500, 501} == language == lines
    texts = {x["doc_id"]: x["text"] for x in spark.read.parquet(str(tmp_path / "line_dedup")).collect()}
    assert sum(banner in t for t in texts.values()) == 1 and banner in texts[501]
    assert 5 in near and 500 not in near and 6 in near and 501 not in near and near >= set(range(120))
    assert mixed and mixed <= near and packed == mixed
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert run.agg(F.sum("length")).first()[0] == out.agg(F.sum("length")).first()[0]


def test_clashing_columns_and_empty_tables_go_through_all_stages(spark, tmp_path):
    extra = ("kept", "row", "lang_pred", "lang_score", "mix_size", "mix_taken", "nid", "body", "h", "_node", "shard", "words", "time", "i", "t", "s")
    text = " ".join("the of and that with this from have not which".split() * 4)
    rows = [(i, f"{text} number {i}x.\nsecond line of {i} here", "en", f"s{i % 2}", 9) for i in range(30)] + [(None, None, None, None, None), (40, "", "en", "s1", 0), (41, "x " * 30000, "en", "s1", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in extra])
    for name, start in (("full", docs), ("empty", docs.limit(0))):
        out = start
        for stage, function in corpus_pipeline.STAGES:
            out = function(spark, out, str(tmp_path))
            if stage != "packing":
                assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / name / stage))
            out = spark.read.schema(out.schema).parquet(str(tmp_path / name / stage))
            if stage != "packing":
                assert all(r[c] == f"{c}{r['doc_id']}" for r in out.collect() for c in extra)
        assert (out.count() > 0) == (name == "full")

import corpus_pipeline
from cellweave.llm.decontaminate import contamination
from cellweave.llm.line_dedup import split_lines
from cellweave.llm.simhash import near_duplicates


def test_stages_in_order_on_planted_documents(spark, tmp_path):
    line = lambda tag, n=14: " ".join(f"{tag}{k}" for k in range(n))
    benchmark = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    clean = {k: f"{line(f'w{k}x', 30)}\n{line(f'v{k}y', 25)}" for k in range(20)}
    docs = [(k, t) for k, t in clean.items()]
    docs += [(100, clean[3]), (101, "\n" + clean[4])]  # copies: nothing of them is left
    docs += [(102, f"{line('own')}\n{clean[5].split(chr(10))[0]}")]  # a repeated line goes, the rest stays
    docs += [(103, "you are a pathetic worthless idiot and a disgusting moron")]
    docs += [(104, f"{line('q')} {benchmark} {line('r')}")]
    docs += [(105, None), (106, ""), (106, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], schema)
    frame.write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, benchmark)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    at, kept = spark.read.parquet(f"file://{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, f"file://{tmp_path}")
        at.write.parquet(f"file://{tmp_path}/out/{name}")
        at = spark.read.parquet(f"file://{tmp_path}/out/{name}")
        kept[name] = at
    ids = lambda name: sorted(r.doc_id for r in kept[name].collect())
    assert ids("toxicity") == sorted([*range(20), 100, 101, 102, 104, 105, 106, 106])
    assert ids("line_dedup") == sorted([*range(20), 102, 104, 105, 106, 106])
    text = {r.doc_id: (r.text, r.n_chars) for r in kept["line_dedup"].collect()}
    assert text[102] == (line("own"), len(line("own"))) and text[3][0] == clean[3]
    assert ids("simhash_near_dedup") == sorted([*range(20), 102, 104, 105])
    assert ids("benchmark_decontamination") == sorted([*range(20), 102, 105])
    for name in list(kept)[:-1]:
        assert kept[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted({r.doc_id for r in kept["best_fit_packing"].collect()}) == ids("benchmark_decontamination")


def test_run_over_a_whole_table(spark, sf):
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        seen = name
    assert seen == "benchmark_decontamination"
    keys = [r.key for r in split_lines(docs, "doc_id", "text").collect()]
    assert len(keys) == len(set(keys))
    groups = near_duplicates(docs).collect()
    assert len({r.component_id for r in groups}) == len(groups) == docs.select("doc_id").distinct().count()
    assert contamination(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).where("size(found_.items) > 0").count() == 0
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").collect()} == {r.doc_id for r in docs.collect()}

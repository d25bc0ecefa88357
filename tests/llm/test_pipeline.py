import re

import corpus_pipeline
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_lsh_forest import brute as brute_groups
from tests.llm.test_packing import check_pieces, check_places
from tests.llm.test_quality import plain
from trestle.llm import langid
from trestle.llm.common import land

SF = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(code):
    docs = land(code.read.parquet(f"{SF}/documents.parquet"))
    columns = docs.columns
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = langid.fit(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = land(stage(code, docs, SF))
        if name == "language_id":
            kept = [not x for x in model.predict(list(rows.values()))[2]]
            rows = {i: t for (i, t), k in zip(rows.items(), kept) if k}
        elif name == "quality_rules":
            rows = {i: t for i, t in rows.items() if plain(t)["failures"] == 0}
        elif name == "line_dedup":
            gone = brute_lines(rows.items())
            rows = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(gone.get(i, ())))
                    for i, t in rows.items()}
            rows = {i: t for i, t in rows.items() if i not in gone or re.search(r"[^\x20\x09-\x0D]", t)}
        elif name == "near_dedup":
            _, component = brute_groups(list(rows), list(rows.values()), 5)
            rows = {i: t for (i, t), c in zip(rows.items(), component) if i == c}
        if name != "packing":
            assert docs.columns == columns
            assert {r["doc_id"]: r["text"] for r in docs.collect()} == rows
            assert docs.filter("n_chars <> length(text)").count() == 0
    got = docs.collect()
    check_pieces(got, rows)
    check_places(got)


def test_run_is_the_stages_in_order(code):
    got = corpus_pipeline.run(code, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 0


def test_stages_survive_odd_and_empty_tables(odd_docs, no_docs, code):
    def shaped(df):
        return df.selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as long) n_chars", "line as score")

    for df in (shaped(odd_docs), shaped(no_docs)):
        columns = df.columns
        for name, stage in corpus_pipeline.STAGES:
            df = land(stage(code, df, SF))
            assert name == "packing" or df.columns == columns
        df.count()

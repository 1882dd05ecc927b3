"""Registered queries return what their operators are for."""

from quire.llm import piece_sampling, simhash_dedup


def test_sampled_pieces_can_be_decoded(spark, tmp_path):
    texts = {1: "a b  c", 2: "", 3: "Released under the MIT License.", 4: "é😀 x"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = piece_sampling.decode_pieces(piece_sampling.op5_sentencepiece(spark, str(tmp_path))).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        assert r["decoded"] == texts[r["doc_id"]] and len(r["ids"]) == r["n_pieces"]


def test_every_component_keeps_one_row(spark):
    a, b, c, d = ("the meadow by the river", "stones and clouds of winter", "garden letters under the lamp", "seven ships on the open sea")
    for given, want in (
        ([(5, a), (9, a), (5, b), (12, b)], [(5, a), (5, b)]),
        ([(1, a), (5, a), (5, c)], [(1, a), (5, c)]),
        ([(5, a), (5, a), (None, a), (None, d), (None, d), (6, None), (7, "")], [(5, a), (None, d), (6, None)]),
        ([(3, d), (2, c), (2, d), (3, c), (1, b)], [(2, d), (2, c), (1, b)]),
    ):
        marks = {x: simhash_dedup.fingerprint(x) for x in (a, b, c, d)}
        assert all((m ^ n).bit_count() > 2 * simhash_dedup.RADIUS for x, m in marks.items() for y, n in marks.items() if x != y)
        got = simhash_dedup.keep_one(spark.createDataFrame(given, "doc_id long, text string").repartition(2)).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)

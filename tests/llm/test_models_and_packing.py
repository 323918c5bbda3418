"""Learned scores and cut-offs, packing and piece encoding."""

from __future__ import annotations

import zlib
from math import comb

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from eventloom.llm import packing, piece_encoding, quality_gam
from eventloom.llm.quality_rules import binomial_tail
from tests.llm import brute

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_and_sequences(docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    rows = packing.pack_documents(docs, BPE, length=256, group_size=9).toPandas()
    by_doc = rows.groupby("doc_id")
    for i, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for piece in by_doc.get_group(i).sort_values("start").itertuples():
            part = ids[at : at + piece.length]
            assert (piece.start, piece.doc_tokens) == (at, len(ids))
            assert piece.ids_crc32 == zlib.crc32(part.tobytes())
            at += piece.length
        assert at == len(ids)
    for _, sequence in rows.sort_values("offset").groupby("sequence_id"):
        ends = sequence["length"].cumsum()
        assert (sequence["offset"].to_numpy() == np.r_[0, ends[:-1]]).all()
        assert ends.iloc[-1] <= 256


def test_both_libraries_agree():
    encode = packing.Encoder(BPE)
    for text in ["a  b\n\n c", "<|endoftext|> x", "Ünïcödé ▁ 漢字 \U0001f600", "", "\x00\x7f", " " * 70]:
        want = encode.slow.encode(text, add_special_tokens=False).ids
        assert encode(text).tolist() == want


def test_first_fit_decreasing_against_a_list():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 101, 300)
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    free: list[int] = []
    for item in np.argsort(-sizes, kind="stable"):
        at = next((k for k, room in enumerate(free) if room >= sizes[item]), len(free))
        if at == len(free):
            free.append(100)
        assert (bins[item], offsets[item]) == (at, 100 - free[at])
        free[at] -= sizes[item]


def test_packing_empty_repeated_and_null(no_docs, odd_docs):
    assert packing.pack_documents(no_docs, BPE).count() == 0
    rows = packing.pack_documents(odd_docs, BPE)
    assert rows.where("start = 0").count() == odd_docs.count()
    assert rows.select("sequence_id", "offset").distinct().count() == rows.count()


def test_words_are_segmented_best():
    pieces = piece_encoding.Pieces(PIECES)
    words = sorted({" the", " theory", " thereof", "x", " é▁z", "\nand", " qqqqq", " 漢字kanji"})
    found = pieces.segment(words)
    for word in words:
        # All segmentations, as sums of scores up to each place.
        best = [0.0] + [-np.inf] * len(word)
        for end in range(1, len(word) + 1):
            for begin in range(end):
                part = word[begin:end]
                value = pieces.score.get(part)
                if value is None and len(part) == 1:
                    value = pieces.byte_score * len(part.encode())
                if value is not None:
                    best[end] = max(best[end], best[begin] + value)
        ids = np.frombuffer(found[word], "<u4").tolist()
        bytes_ = set(pieces.byte)
        by_id = {i: p for p, i in pieces.id.items()}
        total = sum(pieces.byte_score if i in bytes_ else pieces.score[by_id[i]] for i in ids)
        assert total == pytest.approx(best[-1])
        assert found[word] == pieces.segment([word])[word]


def test_round_trip(docs, texts, odd_docs, no_docs):
    rows = piece_encoding.encode_documents(docs, PIECES, with_ids=True, batch_bytes=5_000)
    assert rows.where("round_trip").count() == len(texts)
    back = piece_encoding.decode_documents(rows, PIECES).collect()
    assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t in texts}
    assert piece_encoding.encode_documents(no_docs, PIECES).count() == 0
    assert piece_encoding.encode_documents(odd_docs, PIECES).count() == odd_docs.count()


def test_binomial_tail(spark):
    cases = [(k, n, p) for n in (1, 30, 500) for p in (0.01, 0.2) for k in (0, 1, 4, 90) if k <= n]
    for k, n, p in cases:
        row = spark.range(1).select(
            binomial_tail(F.lit(k), F.lit(n), p).alias("v")
        ).first()
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert row.v == pytest.approx(want if k <= n * p else 1.0, rel=1e-9)


def test_model_learns_steps_and_a_pair():
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 0)).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000])
    right = (model.score(x[3000:]) > 0.5) == (y[3000:] == 1)
    assert right.mean() > 0.93
    assert (0, 1) in model.pairs
    assert quality_gam.fit(x, np.ones(4000)).score(x[:5]).min() > 0.99
    assert quality_gam.fit(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]


def test_features_count_what_they_say(docs, texts):
    import pyarrow as pa

    from eventloom.llm.common import utf8_buffer

    column = pa.chunked_array([[t for _, t in texts[:9]], [t for _, t in texts[9:]]], pa.string())
    values = quality_gam.features(*utf8_buffer(column))
    for (_, text), row in zip(texts, values, strict=True):
        w = brute.words(text)
        per_word = max(len(w), 1)
        got = dict(zip(quality_gam.FEATURES, row, strict=True))
        assert got["words"] == pytest.approx(np.log1p(len(w)))
        assert got["distinct_words"] == pytest.approx(1 - (len(w) - len(set(w))) / per_word)
        assert got["pipes"] == pytest.approx((text or "").count("|") / per_word)
        lines = [x for x in (text or "").split("\n") if x]
        assert got["repeated_lines"] == pytest.approx(
            (len(lines) - len(set(lines))) / max(len(lines), 1)
        )


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_gam.score_documents(docs, labels).join(labels, "doc_id").toPandas()
    fold = rows["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert (rows["held_out"] == fold).all()
    out = rows[rows["held_out"]]
    good, bad = (out[out["quality"] == q]["score"].to_numpy() for q in (1, 0))
    assert (good[:, None] > bad).mean() > 0.95
    assert rows["score"].between(0, 1).all()
    assert (rows["predicted"] == (rows["score"] >= 0.3)).all()


def test_scores_of_odd_rows(odd_docs, no_docs, labels):
    rows = quality_gam.score_documents(odd_docs, labels)
    assert rows.count() == odd_docs.count()
    assert rows.where("score is null or score < 0 or score > 1").count() == 0
    assert quality_gam.score_documents(no_docs, labels).count() == 0


def test_repeated_rows_are_packed_in_many_groups(spark):
    """As many groups of about the size asked for as without repeats."""
    rows = spark.range(3000).selectExpr("1L AS doc_id", "'the same text' AS text")
    packed = packing.pack_documents(rows, BPE, group_size=500)
    sizes = [r[0] for r in packed.groupBy(F.expr("sequence_id >> 32")).count().select("count").collect()]
    assert len(sizes) >= 5 and max(sizes) < 700 and sum(sizes) == 3000

import random
import zlib

import numpy as np
import pytest

from plumbline.llm import packing
from plumbline.llm.queries import word_vocabulary


def check(found, ids, window):
    """Every id in one piece, sequences gapless, and no padding but at full windows or powers of two."""
    by_doc, by_seq = {}, {}
    for key, start, length, crc, total, seq, offset in found:
        by_doc.setdefault(key, []).append((start, length, crc, total))
        by_seq.setdefault(seq, []).append((offset, length))
    for key, own in ids.items():
        at = 0
        for start, length, crc, total in sorted(by_doc[key]):
            assert start == at and total == len(own) and length > 0
            assert crc == zlib.crc32(np.array(own[start:start + length], "<u4").tobytes())
            at += length
        assert at == len(own)
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window and (at == window or at & (at - 1) == 0)


@pytest.mark.parametrize("limit", [3, 4096])
def test_packer(limit):
    rng, rows = random.Random(5), []
    packer = packing.Packer(lambda key, start, ids, total, seq, offset, length: rows.append(
        (key, start, len(ids) // 4, zlib.crc32(ids), total, seq, offset)), window=64, open_limit=limit)
    ids = {i: [rng.randrange(50_000) for _ in range(rng.choice([1, 2, 33, 40, 63, 64, 65, 200, rng.randrange(1, 70)]))]
           for i in range(400)}
    for key, own in ids.items():
        packer.add(key, np.array(own, "<u4").tobytes())
    packer.drain()
    check(rows, ids, 64)


def test_level_choice_minimises_the_sum_of_squares():
    rng = random.Random(6)
    packer = packing.Packer(lambda *a: None, window=32)
    for _ in range(300):
        packer.level[1:32] = [rng.choice([0, 0, 1, 2, 5]) for _ in range(31)]
        size = rng.randrange(1, 32)

        def cost(fill):
            level = packer.level.copy()
            if fill:
                level[fill] -= 1
            if fill + size < 32:
                level[fill + size] += 1
            return int((level[1:32] ** 2).sum())

        options = [h for h in range(0, 32 - size + 1) if h == 0 or packer.level[h] > 0]
        assert cost(packer.best_level(size)) == min(map(cost, options))


def test_whole_texts_against_the_tokenizer(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_vocabulary())
    texts = ["", None, "Hello  WORLD\u00a0it's\x1cfine 123 ¿qué?", "<|endoftext|> a<|startoftext|>b e\u0301 \u0301x",
             "word " * 5000, "x" * 5000, "tab\tnew\nline\x0b\x0c\r😀👩‍👧 İstanbul ﬁ", "same", "same", " \u2003 lead"]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, start int, length int")
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    found = [tuple(r)[:7] for r in packing.pack(df, word_vocabulary()).collect()]
    check(found, ids, 2048)


def test_repeated_and_missing_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string").coalesce(1)
    found = packing.pack(df, word_vocabulary()).collect()
    assert sum(r["length"] for r in found) == 9 and {r["doc_id"] for r in found} == {None, 1}
    assert packing.pack(df.where("false"), word_vocabulary()).count() == 0

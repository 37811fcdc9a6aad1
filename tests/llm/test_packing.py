import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import packing as p

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_best_fit(lengths, capacity):
    """Room left per sequence, piece by piece; among equal rooms any."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            best = min(fits)
            rooms.remove(best)
            rooms.append(best - n)
        else:
            rooms.append(capacity - n)
    return Counter(rooms)


def test_runs_are_best_fit_decreasing():
    rnd = random.Random(1)
    for capacity, sizes in ((10, (1, 10)), (64, (1, 64)), (64, (1, 20)), (100, (20, 60)), (1024, (1, 1024))):
        for n in (0, 1, 5, 60, 400):
            lengths = [rnd.randint(*sizes) for _ in range(n)]
            runs = p.best_fit(dict(Counter(lengths)), capacity)
            at = {}
            for length, first, pieces, sequence, each, offset in runs:
                for k in range(pieces):
                    at.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
            assert sum(map(len, at.values())) == n
            for placed in at.values():
                end = 0
                for offset, length in sorted(placed):
                    assert offset == end
                    end += length
                assert end <= capacity
            assert Counter(capacity - sum(x for _, x in v) for v in at.values()) == plain_best_fit(lengths, capacity)


def test_runs_stay_few_on_large_counts():
    rnd = random.Random(2)
    runs = p.best_fit({n: rnd.randint(1, 10**9) for n in range(1, 1025)})
    assert len(runs) < 20000 and sum(r[2] for r in runs) > 10**11


def test_pack(spark):
    import tokenizers

    rnd = random.Random(3)
    words = ["the", "été", "x", "12", "|", "\n", "  ", "ThTh", "𝔘"]
    texts = [None, "", "<|endoftext|> a", "word " * 30000] + [" ".join(rnd.choice(words) for _ in range(rnd.randrange(900))) for _ in range(120)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(1, "", "en", "s", 0), (None, "z", None, None, None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("task", F.lit(1)).withColumn("length", F.lit("x")).repartition(5)
    tokenizer = p.public_tokenizer()
    exact = tokenizers.Tokenizer.from_file(tokenizer.file)
    out = p.pack(df, tokenizer).collect()
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == {*range(len(texts)), None} and len(by_doc[1]) == 2
    for i, t in enumerate(texts):
        ids = np.array([*exact.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        got = sorted(by_doc[i], key=lambda r: r.piece)[: 1 if i == 1 else None]
        assert sum(r.length for r in got) == len(ids) and all(r.length == 1024 for r in got[1:])
        start = 0
        for k, r in enumerate(got):
            assert (r.piece, r.start) == (k, start)
            assert r.ids_crc32 == zlib.crc32(ids[start : start + r.length].tobytes())
            start += r.length
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 1024
    lengths = [r.length for r in out]
    assert len(by_sequence) == sum(plain_best_fit(lengths, 1024).values())
    assert p.pack(df.limit(0), tokenizer).count() == 0

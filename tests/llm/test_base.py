import random

import pyarrow as pa

from plumbline.llm.base import slices
from plumbline.llm.paragraphs import Paragraphs
from plumbline.llm.words import Words


def test_slices_hold_the_rows_and_are_read_rightly():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("aBé ü\n") for _ in range(rnd.randrange(120))) if i % 9 else None for i in range(700)] + ["x " * 3000, "y"]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["i", "t"])
    for size in (1, 900, 1 << 20):
        parts = list(slices([batch.slice(0, 300), batch.slice(300)], 1, size))
        assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(texts)))
        assert [t for p in parts for t in p.column(1).to_pylist()] == texts
        whole = [Words(pa.array([t])) for t in texts]
        found = [(h, n) for p in parts for w in [Words(p.column(1))] for h, n in zip([w.known[w.code].tolist()], [w.count.tolist()])]
        assert [x for h, _ in found for x in h] == [x for w in whole for x in w.known[w.code].tolist()]
        assert [x for _, n in found for x in n] == [w.count[0] for w in whole]
        nodes = [x for p in parts for x in Paragraphs(p.column(1), 5).nodes().tolist()]
        assert nodes == [x for t in texts for x in Paragraphs(pa.array([t], pa.string()), 5).nodes().tolist()]

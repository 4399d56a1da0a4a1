"""What a Python worker holds on to between batches and tasks."""

import gc
import weakref

import pyarrow as pa

from hirelake.llm import jaccard, packing


def _batches(seen: list) -> pa.RecordBatch:
    """Three batches; ``seen`` gets how many of the earlier ones still exist as each is asked for."""
    alive = []
    for i in range(3):
        gc.collect()
        seen.append(sum(r() is not None for r in alive))
        batch = pa.RecordBatch.from_pydict({"doc_id": [i], "text": [f"one two three four five six {i}"]})
        alive.append(weakref.ref(batch))
        yield batch
        del batch


def test_packing_holds_no_batch_while_the_next_one_comes():
    seen: list = []
    assert [b.num_rows for b in packing.tokenised(_batches(seen), packing.TOKENIZER, 4096)] == [1, 1, 1]
    assert seen == [0, 0, 0]


def test_jaccard_sets_hold_no_batch_while_the_next_one_comes():
    seen: list = []
    out = list(jaccard._sets(_batches(seen), 5, jaccard.CELLS))
    assert [b.num_rows for b in out[:3]] == [1, 1, 1]
    assert seen == [0, 0, 0]


def test_remembered_spans_go_with_their_task():
    a, b = packing.encoder(packing.TOKENIZER), packing.encoder(packing.TOKENIZER)
    assert list(a(["One more, word\x1c"])) == list(b(["One more, word\x1c"]))
    gone = weakref.ref(a)
    del a
    gc.collect()
    assert gone() is None

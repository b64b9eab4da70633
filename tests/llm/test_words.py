import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest_llm import words_of
from loglake import session
from loglake.llm import words as W

TEXT = st.none() | st.text(alphabet="ab \n\t\x0b\x1cé Z", max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=8), st.integers(1, 30))
def test_words_and_windows(texts, limit):
    seen = 0
    for piece in W.slices(pa.array(texts, pa.string()), limit):
        found = W.words(piece)
        own = texts[piece.low : piece.high]
        for t, text in enumerate(own):
            mine = [bytes(piece.data[a:b]).decode() for a, b, o in zip(found.start, found.end, found.text) if o == t]
            assert mine == words_of(text)
        names = [w for t in own for w in words_of(t)]
        assert len({*found.hash.tolist()}) == len({*names})
        values, at = W.shingles(found, 2)
        pairs = [(a, b) for t in own for a, b in zip(words_of(t), words_of(t)[1:])]
        assert len(at) == len(pairs) and len({*values.tolist()}) == len({*pairs})
        seen += piece.size
    assert seen == len(texts)


def test_sliced_columns_keep_their_offsets():
    whole = pa.array(["xx y", None, "a b c", ""])
    data, offsets = W.utf8(whole.slice(1))
    assert data.tobytes() == b"a b c" and offsets.tolist() == [0, 0, 5, 5]
    assert W.utf8(pa.array([], pa.string()))[1].tolist() == [0]


def test_mix_has_no_collisions_in_small_numbers():
    assert len(np.unique(W.mix(np.arange(100_000, dtype=np.uint64)))) == 100_000


def test_tasks_hand_memory_back_when_they_end(monkeypatch):
    """Also when their output is not read to its end."""
    done = []
    monkeypatch.setattr(session, "release_memory", lambda: done.append(1))
    task = session.released(lambda batches: (b + 1 for b in batches))
    assert list(task(iter([1, 2]))) == [2, 3] and done == [1]
    cut = task(iter([1, 2]))
    assert next(cut) == 2 and done == [1]
    cut.close()
    assert done == [1, 1]

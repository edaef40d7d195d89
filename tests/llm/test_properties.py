"""Properties that hold for any input, on the parts that need no Spark session."""

from collections import defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st

from streamweave.llm.near_dedup import linked_pairs, sketches
from streamweave.llm.packing import Open
from streamweave.llm.pii import Pseudonyms, replaced

value = st.sampled_from(["4041894974608795", "+1 (091) 555-3384", "42.144.35.254", "a.b9@mail.example.com", "2024-02-29", "123-45-6789", "12", "x"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(" .,;\nabé😀", max_size=6), value), max_size=8))
def test_pseudonyms_come_back_whatever_stands_around_them(parts):
    text = " ".join(a + " " + v for a, v in parts)
    new, found = replaced(text, Pseudonyms(b"k"))
    assert replaced(new, Pseudonyms(b"k", back=True))[0] == text
    assert all(f["start"] < f["end"] <= len(new) for f in found)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=120), st.integers(1, 6), st.integers(1, 40))
def test_windows_are_gapless_bounded_and_never_overfull(sizes, most, cut):
    windows, fill = Open(100, most, cut), defaultdict(int)
    for size in sizes:
        while size:
            window, offset, n, closed = windows.place(size)
            assert offset == fill[window] and 0 < n <= size
            fill[window] += n
            assert fill[window] <= 100 and closed == (window not in {w for _, w in windows.free})
            size -= n
        assert len(windows.free) <= most
    assert sum(fill.values()) == sum(sizes)
    assert all(free == 100 - fill[w] for free, w in windows.free)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=12), min_size=2, max_size=10), st.integers(1, 100))
def test_linked_pairs_join_what_all_pairs_join(sets, over):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    got = linked_pairs(arrays, np.zeros(len(sets), np.int64), over, 100)
    assert len(got) < len(sets)  # a forest

    def classes(pairs):
        root = list(range(len(sets)))
        for a, b in pairs:
            x, y = root[a], root[b]
            root = [x if r == y else r for r in root]
        return [[root.index(r) for r in root]]

    every = [(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= over * len(sets[i] | sets[j])]
    assert classes(got) == classes(every)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sets(st.integers(0, 2 ** 63), min_size=1, max_size=40), min_size=1, max_size=6), st.sampled_from([1, 7, 64]))
def test_sketches_depend_on_the_set_alone(sets, t):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    together = sketches(arrays, t)
    for a, row in zip(arrays, together):
        assert np.array_equal(sketches([a], t)[0], row)

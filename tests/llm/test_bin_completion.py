"""The packing search ends, and is optimal where a full search can tell."""

import collections
import random
import time

import pytest

from relspark.llm import packing


def used(patterns):
    out = collections.Counter()
    for lengths, times in patterns:
        for x in lengths:
            out[x] += times
    return out


def sequences(patterns):
    return sum(t for _, t in patterns)


def fewest(items, capacity):
    """Every way to place every piece."""
    items, best = sorted(items, reverse=True), [len(items)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        tried = set()
        for i, room in enumerate(rooms):
            if room >= items[k] and room not in tried:
                tried.add(room)
                rooms[i] -= items[k]
                place(k + 1, rooms)
                rooms[i] += items[k]
        rooms.append(capacity - items[k])
        place(k + 1, rooms)
        rooms.pop()

    place(0, [])
    return best[0]


@pytest.mark.parametrize(
    "counts, capacity", [({33: 200, 2: 3300}, 64), ({1025: 3000, 2: 1_543_000}, 2048), ({3: 1_364_000}, 2048), ({1: 5000, 2: 5000}, 2048), ({k: 200 for k in range(1, 2048, 7)}, 2048), ({700: 3000, 690: 2000, 660: 1500, 2: 9}, 2048)]
)
def test_search_ends_with_the_incumbent_or_better(counts, capacity):
    began = time.process_time()
    found = packing.complete(counts, capacity)
    assert time.process_time() - began < 10
    assert used(found) == collections.Counter(counts) and all(sum(p) <= capacity for p, _ in found)
    assert packing.lower_bound(counts, capacity) <= sequences(found) <= sequences(packing.best_fit(counts, capacity))


def test_room_for_very_many_short_pieces_needs_no_recursion_for_each():
    left = packing._Histogram({2: 2000})
    found, _, _ = packing._fillings(left, 2046, 2048, 4, 1600)
    assert found[0] == ((2, 1023),)


def test_small_cases_are_optimal():
    rnd = random.Random(1)
    for _ in range(400):
        items = [rnd.randint(1, rnd.choice([7, 10, 12, 20])) for _ in range(rnd.randint(1, 11))]
        found = packing.complete(collections.Counter(items), 20)
        assert used(found) == collections.Counter(items) and sequences(found) == fewest(items, 20)

from __future__ import annotations

import random

import pytest

from reelstar.operators import incremental as inc
from reelstar.schemas import MARKS

ROWS = "media_id string, page int, id int, at string"
def frames(spark, pages, marks):
    data = [(m, p, i, at) for (m, p), page in pages.items() for i, at in enumerate(page)]
    state = [("events", m, mark) for m, mark in marks.items()]
    return spark.createDataFrame(data, ROWS), spark.createDataFrame(state, MARKS)


def random_case(seed):
    rng = random.Random(seed)
    pages, marks = {}, {}
    for media in ("a", "b", "c", "d"):
        for page in range(1, rng.randrange(2, 7)):
            if rng.random() < 0.12:
                continue
            day = 30 - 3 * page
            pages[media, page] = [
                None if rng.random() < 0.08 else f"2024-01-{max(1, day - i):02d}T00:00:00.000000Z"
                for i in range(rng.randrange(1, 5))
            ]
        mark = rng.choice([None, "1970-01-01T00:00:00Z", "2024-01-15T00:00:00.000000Z", "x"])
        if mark == "x":
            mark = f"2024-01-{rng.randrange(1, 31):02d}T00:00:00.000000Z"
        if mark is not None:
            marks[media] = mark
    return pages, marks


@pytest.mark.parametrize("compare", ["parsed", "text"])
def test_every_row_above_the_mark_is_taken_and_the_mark_follows(spark, compare):
    # all cases as one frame: videos of different cases get different names
    pages, marks = {}, {}
    for seed in range(40):
        some_pages, some_marks = random_case(seed)
        pages |= {(f"{seed}{m}", p): rows for (m, p), rows in some_pages.items()}
        marks |= {f"{seed}{m}": mark for m, mark in some_marks.items()}
    rows, state = frames(spark, pages, marks)
    marked = inc.with_marks(rows, state, "events", "at", compare).cache()
    after = {
        r["media_id"]: r["high_water"]
        for r in inc.next_marks(marked, state, "events", compare).collect()
    }
    taken = {(r["media_id"], r["page"], r["id"]) for r in marked.filter("_is_new").collect()}
    want_taken, want_marks = set(), {}
    for media in {m for m, _ in pages} | set(marks):
        mark = marks.get(media)
        mark = None if mark == "1970-01-01T00:00:00Z" else mark
        times = [at for (m, _), page in pages.items() if m == media for at in page]
        want_taken |= {
            (media, p, i) for (m, p), page in pages.items() if m == media
            for i, at in enumerate(page) if mark is None or (at or "") > mark
        }
        best = max(filter(None, [mark, *times]), default=None)  # a mark never moves back
        if best:
            want_marks[media] = best
    assert taken == want_taken
    assert after == want_marks


def test_filter_and_late_rows_split_the_input(spark):
    pages = {("a", 1): ["2024-01-03T00:00:00Z", "2024-01-02T00:00:00Z", None], ("b", 1): [None]}
    rows, state = frames(spark, pages, {"a": "2024-01-02T00:00:00Z"})
    new = inc.incremental_filter(rows, state, "events", "at").collect()
    late = inc.late_rows(rows, state, "events", "at").collect()
    # strictly above the mark; without a mark a row without time is taken
    assert sorted((r["media_id"], r["id"]) for r in new) == [("a", 0), ("b", 0)]
    assert sorted((r["media_id"], r["id"]) for r in late) == [("a", 1), ("a", 2)]


def test_marks_of_another_endpoint_do_not_count(spark):
    rows, state = frames(spark, {("a", 1): ["2024-01-03T00:00:00Z"]}, {"a": "2024-02-01T00:00:00Z"})
    assert inc.incremental_filter(rows, state, "visitors", "at").count() == 1


def test_offsets_are_compared_as_instants(spark):
    pages = {("a", 1): ["2024-01-02T23:00:00-05:00"]}
    rows, state = frames(spark, pages, {"a": "2024-01-03T00:00:00Z"})
    assert inc.incremental_filter(rows, state, "events", "at").count() == 1
    assert inc.incremental_filter(rows, state, "events", "at", "text").count() == 0

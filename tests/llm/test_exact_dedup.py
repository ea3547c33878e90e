import hashlib
from collections import defaultdict

import pytest

from rivulet.llm.exact_dedup import drop_copies, exact_dedup
from tests.llm.corpora import CLASHES, awkward, frame


def brute(rows, pick=max):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[text or ""].append(i)
    out = []
    for i, text, *_ in rows:
        ids = [x for x in groups[text or ""] if x is not None]
        out.append((i, pick(ids) if ids else None, len(groups[text or ""]), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("keep, pick", [("max", max), ("min", min)])
@pytest.mark.parametrize("runs, radix", [(64, 4), (5, 2), (1, 4)])
def test_groups_as_by_hand(spark, keep, pick, runs, radix):
    rows = awkward() + [(i, f"t{i % 7}") for i in range(100, 160)]
    assert got(exact_dedup(frame(spark, rows), keep=keep, runs=runs, radix=radix)) == brute(rows, pick)


def test_one_row_of_each_text_is_kept(spark):
    rows = awkward()
    df = exact_dedup(frame(spark, rows, clash=True))
    kept = [r.text_sha256 for r in df.collect() if r.kept]
    assert len(kept) == len(set(kept)) == len({t or "" for _, t, *_ in rows})


def test_kept_rows_come_with_their_columns(spark):
    rows = awkward()
    df = drop_copies(frame(spark, rows, clash=True))
    assert df.columns[-len(CLASHES) :] == CLASHES
    texts = [r.text or "" for r in df.collect()]
    assert sorted(texts) == sorted({t or "" for _, t, *_ in rows})


def test_empty(spark):
    assert exact_dedup(frame(spark, [])).collect() == []
    assert drop_copies(frame(spark, [])).collect() == []

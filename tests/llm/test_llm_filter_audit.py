"""The filter audit against plain loops over documents, and its scanner against plain words."""

import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from tidewire.llm import filter_audit

RNG = random.Random(1)
TEXTS = [None, "", " ", "a", "a a  b\tA #é日🎉", "x" * 5000, "é ß " * 3000, *("".join(RNG.choice(" \n\tabAB#é日") for _ in range(RNG.randint(0, 200))) for _ in range(200))]


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


@pytest.mark.parametrize("chunk", [1 << 21, 64, 7])
@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_scanner(monkeypatch, chunk, kind):
    monkeypatch.setattr(filter_audit, "CHUNK", chunk)
    column = pa.array([None if t is None else t.encode() for t in ["skipped", *TEXTS]], kind).slice(1)
    assert filter_audit.text_counts(column, filter_audit.Scanner()).tolist() == [plain_counts(t) for t in TEXTS]


def test_words_that_share_a_hash_are_told_apart(monkeypatch):
    """All words get one of two hashes: equal hashes must not count as equal words."""
    words = filter_audit.Scanner.words
    monkeypatch.setattr(filter_audit.Scanner, "words", lambda self, data, at: (*(found := words(self, data, at))[:2], found[2] % np.uint64(2)))
    column = pa.array([(t or "").encode() for t in TEXTS], pa.binary())
    assert filter_audit.text_counts(column, filter_audit.Scanner()).tolist() == [plain_counts(t) for t in TEXTS]


def plain_audit(docs, labels):
    good, bad = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    rows = []
    for i, text, source in docs:
        words, kinds, capitals, points, symbols = plain_counts(text)
        copy = i is not None and any(j is not None and j < i and (other or "") == (text or "") for j, other, _ in docs)
        rows.append((i, source or "", dict(zip("ABCDE", (words < 50, 100 * kinds < 65 * words, 100 * capitals > 5 * points, symbols > 0, copy)))))
    out = {}
    for part in {r[1] for r in rows}:
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            here = [r for r in rows if r[1] == part]
            for step, f in enumerate(order, 1):
                removed, gone = [r for r in here if r[2][f]], [r for r in rows if r[1] == part and r[2][f] and r not in here]
                here = [r for r in here if not r[2][f]]
                removed_by[f] += len(removed)
                only = sum(r[1] == part and r[2][f] and sum(r[2].values()) == 1 for r in rows)
                out[part, order, step] = [len(here), len(removed), len(gone), only, sum(r[0] in good for r in removed), sum(r[0] in bad for r in removed)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(removed_by[order[step - 1]])
    return out


def test_audit_against_loops(odd_docs, labels):
    docs = [(r.doc_id, r.text, r.source) for r in odd_docs.where("text IS NULL OR length(text) < 3000").select("doc_id", "text", "source").collect()]
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in filter_audit.audit_filters(odd_docs.where("text IS NULL OR length(text) < 3000"), labels).collect()}
    want = plain_audit([(i, t, s) for i, t, s in docs], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert got == want and len(got) == 600 * len({p for p, _, _ in got})


def test_no_documents(no_docs, labels):
    assert filter_audit.audit_filters(no_docs, labels).count() == 0

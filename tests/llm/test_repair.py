import functools
import hashlib
import itertools
import random
from collections import defaultdict

import pytest

from vcat.llm import repair

AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def plain(rows):
    """The contract by memoized search: rows (role, text) in order, of one conversation."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\f\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @functools.cache
    def best(i, q, inserted):
        out = []
        if i == len(rows) and q in ("", "a"):
            out.append((0, "", ()))
        if inserted < 3:
            c, s, r = best(i, NEXT[q], inserted + 1)
            out.append((c + 5, "I" + s, (({"u": "user:", "a": "assistant:"}[NEXT[q]]),) + r))
        if i < len(rows):
            role, text = rows[i]
            c, s, r = best(i + 1, q, 0)
            out.append((c + 2, "D" + s, r))
            if faults[i] not in ("blank", "duplicate"):
                cut = 5 * (faults[i] == "truncated")
                if (q, role[:1]) in AFTER:
                    c, s, r = best(i + 1, AFTER[q, role[:1]], 0)
                    out.append((c + cut, "K" + s, (f"{role}:{text}",) + r))
                c, s, r = best(i + 1, NEXT[q], 0)
                out.append((c + cut + 1, "R" + s, ({"u": "user:", "a": "assistant:"}[NEXT[q]] + text,) + r))
        return min(out) if out else (10**9, "", ())

    cost, audit, lines = best(0, "", 0)
    wrong = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), wrong, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def some_rows(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "ufo", " "]
    return [(rng.choice(roles[:5] if rng.random() < 0.8 else roles), rng.choice(["Yes.", "No!", "and so", "", " \n", f"Row {rng.randrange(99)}.", "é?", "x"])) for _ in range(n)]


def test_auction_against_search():
    rng = random.Random(3)
    for n in [*range(9)] * 60:
        rows = some_rows(rng, n)
        want = plain(rows)
        seen, codes = set(), []
        for role, text in rows:
            codes.append(repair.row_code(role, *repair._faults(role, text, (role, text) not in seen)))
            seen.add((role, text))
        ((cost, _, audit),) = repair.solve(bytes(codes), tuple(c for c, _ in repair.LAST), tuple(t for _, t in repair.LAST), (0,))
        assert (cost, audit) == want[4:6], rows


def check(docs, rows):
    got = {r.conv_id: tuple(r)[1:] for r in repair.digest(repair.repair(docs(rows, "conv_id long, turn long, role string, text string, seg string"))).collect()}
    convs = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        convs[conv].append((turn, role or " " if role is None else role, " " if text is None else text))
    assert set(got) == set(convs)
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        assert got[conv] == (gaps, *plain([r[1:] for r in own])), conv


def test_conversations_of_all_kinds(docs):
    rng = random.Random(4)
    rows = []
    for conv in [*range(40), None]:
        for role, text in some_rows(rng, rng.randrange(1, 9)):
            rows.append((conv, rng.choice([None, *range(9)]), role if rng.random() < 0.95 else None, text if rng.random() < 0.95 else None, "x"))
    rows += rng.sample(rows, 20)
    rows.append((99, None, "user", "One.", None))
    rows.append((98, 1, "user", "long " * 400_000, None))
    check(docs, rows)
    assert repair.digest(repair.repair(docs([], "conv_id long, turn long, role string, text string"))).count() == 0


@pytest.mark.parametrize("fanout", [2, 256])
def test_long_conversations_are_segments(docs, monkeypatch, fanout):
    monkeypatch.setattr(repair, "SEGMENT", 5)
    monkeypatch.setattr(repair, "FANOUT", fanout)
    rng = random.Random(fanout)
    rows = [(conv, rng.randrange(n), *r, "x") for conv, n in ((1, 60), (2, 21), (3, 5), (4, 6)) for r in some_rows(rng, n)]
    check(docs, rows)

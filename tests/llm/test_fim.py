import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import odd
from tidewater.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MORE = [(20, "holds <S> itself", "en", "a"), (21, "  lead and trail \n", "en", "a"), (22, "a<P b> <", "en", "a"), (23, "\x1c x\x85y z　w", "en", "a")]
MORE += [(30 + i, " ".join(f"é{j}日" for j in range(i)), "en", "a") for i in range(40)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n, drawn = len(units), sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(drawn[i:i + 8], 16) for i in (0, 8, 16, 24))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_operator_equals_brute_force_on_odd_rows(spark):
    docs = odd.documents(spark, odd.DOCS + MORE)
    got = fim.restore(fim.transform(docs)).collect()
    want = [{"d": d, "v": (*brute(d, t), sha(brute(d, t)[4]), t or "", sha(t or ""))} for d, t, _, _ in odd.DOCS + MORE]
    have = [{"d": r.row.doc_id, "v": (r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.output_sha256, r.restored, r.restored_sha256)}
            for r in got]
    assert odd.by_id(have, "d", "v") == odd.by_id(want, "d", "v")
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert all(r.row.kept == "kept" and r.row.text == next(t for d, t, *_ in odd.DOCS + MORE if d == r.row.doc_id) for r in got if r.row.doc_id)
    for r in got:  # the descriptors spell the output
        text = (r.row.text or "").encode()
        assert b"".join(fim.spelled([fim.Piece(p.buffer, p.begin, p.end) for p in r.pieces], text)).decode() == r.output


def test_empty_table(spark):
    assert fim.restore(fim.transform(odd.documents(spark, []))).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a<>PSM \té", max_size=30), st.lists(st.integers(0, 40), max_size=4), st.sampled_from(["psm", "spm"]))
def test_cuts_and_arrangements_are_undone(text, places, form):
    data = text.encode()
    pieces = [fim.Piece(fim.TEXT, 0, len(data))] if data else []
    for at in places:
        left, right = fim.cut(pieces, min(at, len(data)))
        assert b"".join(fim.spelled(left, data)) == data[:min(at, len(data))]
        pieces = left + right
        assert b"".join(fim.spelled(pieces, data)) == data and all(p.end > p.begin for p in pieces)
    if any(m in data for m in fim.MARKS):
        return
    low, high = sorted((*[min(p, len(data)) for p in places[:2]], 0, len(data))[:2])
    rest, suffix = fim.cut(pieces, high)
    prefix, middle = fim.cut(rest, low)
    output = b"".join(fim.spelled(fim.arrange([prefix, middle, suffix], form), data))
    assert b"".join(fim.spelled(fim.find_parts(output, form), output)) == data
    assert fim.digest(pieces, data) == hashlib.sha256(data).hexdigest()


def test_an_output_without_its_sentinels_is_an_error():
    with pytest.raises(ValueError):
        fim.find_parts(b"<P>a<S>b<M>c", "spm")

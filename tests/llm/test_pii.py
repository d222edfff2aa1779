from __future__ import annotations

import re

from capstream.llm import op8_pii as op
from hypothesis import given, settings
from hypothesis import strategies as st


def slow(text):
    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m)) <= 19 and op.luhn(digits(m))]
    found += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return found


PIECES = st.sampled_from([*"ab1234567890.-@+()% \n,é٣", "4111111111111111", "10.0.0.1", "+1 (634) 555-6093", "a.b@c.de"])


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=30).map("".join))
def test_base_spans(text):
    assert op.base_spans(text) == slow(text)


def test_long_odd_texts_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "@" * 200_000, "+1" * 200_000, "a@" * 200_000, "1 " * 200_000):
        op.spans_of(text, op.trained())


def test_added_spans():
    model = op.trained()
    kinds = lambda text: [(op.KINDS[k], text[a:b]) for k, a, b in op.spans_of(text, model)[1]]
    assert kinds("write to bob [at] mail [dot] com now") == [("email", "bob [at] mail [dot] com")]
    assert kinds("call (634) 555-6093 today") == [("phone", "(634) 555-6093")]
    assert kinds("card 4111.1111.1111.1111 ok") == [("card", "4111.1111.1111.1111")]
    for clean in ("id 1234567890123456", "server 10.0.0.300", "on 2024-01-31 12:30:00", "isbn 978-0-306-40615-7", "no digits at all", ""):
        assert kinds(clean) == []


def test_held_out_examples():
    import random

    model, hit, gold, said = op.trained(), 0, 0, 0
    for text, spans in op._examples(300, random.Random(99)):
        found = set(model.decode(text, op.tokens_of(text)))
        hit += len(found & set(spans))
        gold += len(spans)
        said += len(found)
    assert hit / gold > 0.9 and hit / said > 0.9


def test_base_spans_stay_and_added_ones_do_not_touch_them():
    model = op.trained()
    text = "38.253.197.126 4880761348116108 and a@b.com, (634) 555-6093"
    base, spans = op.spans_of(text, model)
    assert set(base) <= set(spans)
    extra = [s for s in spans if s not in base]
    assert extra and not any(a < y and x < b for _, a, b in extra for _, x, y in base)


def test_long_lists_are_searched_to_their_end():
    model = op.trained()
    phone = lambda i: f"({200 + i % 700}) 555-{1000 + i:04d}"
    for n in (49, 60, 500):
        for line, kind in ((lambda i: (f"ann berg tel {phone(i)}", phone(i)), "phone"), (lambda i: (f"ann{i} [at] example [dot] com", f"ann{i} [at] example [dot] com"), "email")):
            text = "\n".join(line(i)[0] for i in range(n))
            spans = [(op.KINDS[k], text[a:b]) for k, a, b in op.spans_of(text, model)[1]]
            assert spans == [(kind, line(i)[1]) for i in range(n)]


def test_numbers_in_one_run_are_searched():
    model = op.trained()
    for sep in (" ", ", "):
        phones = [f"({200 + 7 * i}) 555-{1000 + 37 * i}" for i in range(20)]
        text = "call " + sep.join(phones)
        assert [text[a:b] for k, a, b in op.spans_of(text, model)[1] if k == 3] == phones


def test_decoding_is_that_of_the_whole_lattice():
    import random

    model = op.trained()
    for text, _ in op._examples(60, random.Random(12)):
        tokens = op.tokens_of(text)
        best = [0.0]
        for ends in model.lattice(text, tokens)[1:]:
            best.append(max(best[i] + model.value(f) for i, _, f in ends))
        got = {(tokens_start, end): k + 1 for k, tokens_start, end in model.decode(text, tokens)}
        score, j = 0.0, 0
        while j < len(tokens):
            end = next((e for (a, e) in got if a == tokens[j][0]), None)
            i, j = j, j + 1 if end is None else next(x + 1 for x, t in enumerate(tokens) if t[1] == end)
            score += next(model.value(f) for a, y, f in model.lattice(text, tokens)[j] if (a, y) == (i, got.get((tokens[i][0], end), 0)))
        assert abs(score - best[-1]) < 1e-9

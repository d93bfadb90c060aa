"""Formatting of conversations: round trips, spans, templates that rewrite, and odd rows."""

import hashlib
import random

import pytest

from cellweave.llm.chat import KEPT, MARKED, MARKS, Template, escape_marks, format_conversations, read_back, read_marked, render_marked, spans_of, unescape_marks

SCHEMA = "conv_id long, turn long, role string, text string, n long, piece string, start string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "own", "own") for r in rows], SCHEMA)


def hostile_texts(n, seed=1):
    rng = random.Random(seed)
    bits = [*MARKS, "\\", "\\\\", "<", "[", "s>", "SYS>>", "INST]", "a", " ", "\n", "é", "😀", ""]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(8))) for _ in range(n)]


def test_escaping_is_reversible_and_leaves_no_mark():
    for text in hostile_texts(3000):
        assert unescape_marks(escape_marks(text)) == text
        assert not any(m in escape_marks(text) for m in MARKS)


def test_a_piece_gives_back_role_and_text():
    for text, role in zip(hostile_texts(2000), hostile_texts(2000, 2), strict=True):
        for r in ("user", "assistant", "system", role):
            assert read_marked(render_marked([(r, escape_marks(text))])) == (r, text)


def test_spans_tile_the_output_and_bound_the_texts():
    turns = [(r, escape_marks(t)) for r, t in zip(["system", "user", "assistant", "tool"] * 100, hostile_texts(400), strict=True)]
    whole = render_marked(turns)
    for template in (MARKED, Template(render_marked)):  # 400 turns: with a window the oldest are let go
        assert len(turns) > 2 * KEPT + 1
        spans = list(spans_of(template, iter(turns)))
        assert "".join(s[0] for s in spans) == whole and [s[2] for s in spans[:-1]] == [s[1] for s in spans[1:]]
        assert [whole[s[3] : s[4]] for s in spans] == [t for _, t in turns] and not any(s[5] for s in spans)


def test_templates_that_rewrite_history_are_detected():
    def system_last(turns):  # the system text goes into the last user turn
        system = "".join(t for r, t in turns if r == "system")
        last = max((i for i, (r, _) in enumerate(turns) if r == "user"), default=-1)
        return "".join(f"[{r}:{system + '|' if i == last else ''}{t}]" for i, (r, t) in enumerate(turns) if r != "system")

    def stripped(turns):
        return "".join(f"<{r}>{t.strip()}" for r, t in turns)

    def ended(turns):  # an end behind the whole
        return "".join(f"<{r}>{t}" for r, t in turns) + "<end>"

    turns = [("system", "be kind"), ("user", "one"), ("assistant", "two"), ("user", "three"), ("assistant", "four")]
    spans = list(spans_of(Template(system_last), iter(turns)))
    whole = system_last(turns)
    assert [s[5] for s in spans] == [False, False, False, True, False] and "".join(s[0] for s in sorted(spans, key=lambda s: s[1:3])) == whole
    assert [whole[s[3] : s[4]] for s in spans] == [t for _, t in turns]
    spans = list(spans_of(Template(ended), iter(turns)))
    assert [s[5] for s in spans] == [False, True, True, True, True]
    assert [ended(turns)[s[3] : s[4]] for s in spans] == [t for _, t in turns] and "".join(s[0] for s in spans) == ended(turns)
    spans = list(spans_of(Template(stripped), iter([("user", " a "), ("assistant", "b")])))
    assert [s[3] is None for s in spans] == [True, False] and not any(s[5] for s in spans)


def test_a_window_that_is_not_kept_raises():
    def counting(turns):
        return "".join(f"{i % 7}:{t};" for i, (_, t) in enumerate(turns))

    with pytest.raises(ValueError, match="depends on turns before"):
        list(spans_of(Template(counting, window=1), iter([("user", "a")] * 500)))
    with pytest.raises(ValueError, match="rewrites"):
        list(spans_of(Template(lambda t: f"{len(t)}{t}", window=1), iter([("user", "a")] * 3)))


def brute(rows):
    convs = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(render_marked([(r, escape_marks(t)) for r, t in turns])))
    return out


def test_odd_rows_and_a_hot_conversation(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, None, None), (1, None, "assistant", ""), (None, 1, "assistant", "x"), (None, 0, "user", "y"), (2, 5, "User", "z" * 200_000), (3, 0, "assistant", "😀</s>")]
    rows += [(9, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(hostile_texts(1500))]
    formatted = format_conversations(frame(spark, rows).repartition(5))
    got = {r[0]: tuple(r)[1:] for r in read_back(formatted).collect()}
    assert got == brute(rows)
    hot = formatted.where("conv_id = 9").orderBy("n").collect()
    assert [r.n for r in hot] == list(range(1500)) and [r.turn for r in hot] == list(range(1500))
    assert read_back(format_conversations(frame(spark, []))).count() == 0

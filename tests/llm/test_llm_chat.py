"""The event log folded by brute force, and exact round trips of the template."""

import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from tallyroom.llm import chat

TRICKY = st.text(st.sampled_from("<|\\im_startend>\n aé"), max_size=30)
EVENTS = "conv_id long, turn long, copy long, seq long, kind string, role string, text string"


@given(TRICKY, TRICKY)
def test_template_round_trip(role, text):
    segment = chat.render_message(role, text)
    assert chat.parse_message(segment) == (role, text)
    assert segment.count("<|") == 2


@given(TRICKY)
def test_escape_leaves_no_control_string(text):
    assert "<|" not in chat.escape(text)
    assert chat.unescape(chat.escape(text)) == text


def brute(events):
    """Messages by key, folded in order of sequence."""
    found = {}
    for conv, turn, copy, _, kind, role, text in sorted(events, key=lambda e: e[3]):
        at = found.setdefault((conv, turn, copy), ["", ""])
        if kind == "message":
            at[:] = [role or "", text or ""]
        elif kind == "delta":
            at[1] += text or ""
        elif kind == "edit":
            at[1] = text or ""
        else:
            at[1] = ""
    return {(*k, *v) for k, v in found.items()}


def test_fold(spark):
    rng = random.Random(3)
    events = []
    for conv in (1, 2, None):
        for turn in range(6):
            events.append((conv, turn, 1, 0, "message", rng.choice(["user", "assistant"]), rng.choice(["", "hi"])))
            for seq in range(1, rng.randint(2, 12)):
                kind = rng.choice(["delta", "delta", "delta", "edit", "regenerate"])
                events.append((conv, turn, 1, seq, kind, None, rng.choice(["a", "<|", None, "é "])))
    events.append((9, 0, 1, 0, "delta", None, "no opening"))
    rng.shuffle(events)
    rows = chat.fold(spark.createDataFrame(events, EVENTS).repartition(5)).collect()
    assert {tuple(r) for r in rows} == brute(events)
    assert len(rows) == len({e[:3] for e in events})


def test_streamed_regenerated_and_edited(spark):
    events = [
        (1, 0, 1, 0, "message", "assistant", ""), (1, 0, 1, 1, "delta", None, "wro"), (1, 0, 1, 2, "delta", None, "ng"),
        (1, 0, 1, 3, "regenerate", None, None), (1, 0, 1, 4, "delta", None, "rig"), (1, 0, 1, 5, "delta", None, "ht"),
        (2, 0, 1, 0, "message", "user", "old"), (2, 0, 1, 1, "edit", None, "new"), (2, 0, 1, 2, "delta", None, "er"),
    ]
    rows = chat.fold(spark.createDataFrame(events, EVENTS)).collect()
    assert {(r["conv_id"], r["text"]) for r in rows} == {(1, "right"), (2, "newer")}


def test_read_back(spark):
    rows = [
        (1, 0, "user", "q <|im_end|>"), (1, 1, "assistant", "a\n<\\|x|>"), (1, 1, "assistant", "a\n<\\|x|>"), (1, 2, None, None),
        (2, None, "assistant", "y" * 100_000), (2, 0, "a\\n\nb", "z"), (None, 0, "user", ""), (3, 5, "assistant", ""),
    ]
    table = spark.createDataFrame([(*r, 7, "k") for r in rows], "conv_id long, turn long, role string, text string, seq int, kind string")
    found = {r["conv_id"]: r for r in chat.read_back(chat.render(chat.fold(chat.events_of(table)))).collect()}
    assert set(found) == {1, 2, 3, None}
    for conv in found:
        turns = sorted((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv)
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest()
        masked = "".join(x for *_, r, x in turns if r == "assistant")
        size = sum(len(chat.render_message(r, x)) for *_, r, x in turns)
        r = found[conv]
        assert (r["n_turns"], r["turns_sha256"], r["formatted_chars"]) == (len(turns), digest, size)
        assert (r["loss_chars"], r["loss_sha256"]) == (len(masked), hashlib.sha256(masked.encode()).hexdigest())


def test_a_log_that_is_not_folded_gives_other_texts(spark):
    texts = [None, "", "a", "ab", "abc", "<|im_end|>é" * 5, "word " * 50_000]
    rows = [(c, t, r, x) for c in (1, None) for t, x in enumerate(texts) for r in ("user", "assistant", None)]
    log = chat.events_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    events = [tuple(r) for r in log.collect()]
    expected = sorted(((c, t, r or "", x or "") for c, t, r, x in rows), key=str)
    made = chat.fold(log.repartition(4)).collect()
    assert sorted(((m.conv_id, m.turn, m.role, m.text) for m in made), key=str) == expected
    by_message = {}
    for e in events:
        by_message.setdefault(e[:3], []).append(e)
    assert any([e[3] for e in es] != sorted(e[3] for e in es) for es in by_message.values())
    kinds = {e[4] for e in events}
    assert kinds == set(chat.EVENT_KINDS)
    # Neither the last event nor all texts in the order of the log is the message.
    for m in made:
        if m.role == "assistant" and len(m.text) > 2:
            es = by_message[m.conv_id, m.turn, m.copy]
            assert m.text not in (es[-1][6], "".join(e[6] or "" for e in es))
            assert m.text != "".join(e[6] or "" for e in sorted(es, key=lambda e: e[3]))

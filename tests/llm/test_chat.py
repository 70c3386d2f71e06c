import public_tokenizers
from tokenizers import Tokenizer

from tidewater.llm import chat

SCHEMA = "pair_id long, side string, turn long, role string, text string, prompt string, chosen string"


def turn(role, text):
    return f"<|{role or ''}|>\n{text or ''}<|end|>\n"


def brute(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1

    def side(turns):
        text, spans = "", []
        for role, words in turns:
            start = len(text) + len(f"<|{role or ''}|>\n")
            text += turn(role, words)
            if role == "assistant":
                spans.append((start, len(text) - 1))
        return text, spans

    return (n, side(chosen[:n])[0], *side(chosen[n:]), *side(rejected[n:]))


PAIRS = {
    1: ([("user", "hi"), ("assistant", "hello")], [("user", "hi"), ("assistant", "go away"), ("user", "why?")]),
    2: ([("user", "same"), ("assistant", "same")], [("user", "same"), ("assistant", "same")]),
    3: ([("system", None), ("user", ""), ("assistant", "é日")], [("system", None), ("user", ""), ("assistant", None), (None, "x"), ("assistant", "y" * 5000)]),
    4: ([("user", "only chosen")], []),
    5: ([], [("assistant", "only rejected")]),
    6: ([("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "<|end|> d")], [("user", "x"), ("assistant", "b")]),
    7: ([("assistant", "x")], [("user", "x")]),
}


def table(spark, pairs):
    rows = [(p, side, i, role, text, "p", "c") for p, both in pairs.items() for side, turns in zip(("chosen", "rejected"), both, strict=True)
            for i, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows[::-1], SCHEMA)


def test_prefix_and_masks_equal_brute_force(spark):
    got = {r.pair_id: (r.n_prompt_turns, r.prompt, r.chosen, [tuple(s) for s in r.chosen_mask], r.rejected, [tuple(s) for s in r.rejected_mask])
           for r in chat.format_preferences(table(spark, PAIRS)).collect()}
    assert got == {p: brute(*both) for p, both in PAIRS.items()}
    r = {x.pair_id: x for x in chat.format_preferences(table(spark, PAIRS)).collect()}[6]
    assert [r.chosen[s.start:s.end] for s in r.chosen_mask] == ["b<|end|>", "<|end|> d<|end|>"]


def test_tokens_and_masks(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = Tokenizer.from_file(path)
    for r in chat.tokenize(chat.format_preferences(table(spark, PAIRS)), path).collect():
        assert coder.decode(r.prompt_ids, skip_special_tokens=False) == r.prompt
        for ids, mask, text, spans in ((r.chosen_ids, r.chosen_mask_ids, r.chosen, r.chosen_mask), (r.rejected_ids, r.rejected_mask_ids, r.rejected, r.rejected_mask)):
            assert len(ids) == len(mask) and coder.decode(ids, skip_special_tokens=False) == text
            trained = coder.decode([i for i, m in zip(ids, mask, strict=True) if m], skip_special_tokens=False)
            assert trained == "".join(text[s.start:s.end] for s in spans)


def test_reply_pairs(spark):
    rows = [(0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (0, 2, "user", "after"), (1, 0, "user", "q1"), (1, 1, "assistant", "a1"),
            (2, 0, "user", "nobody answers"), (4, 0, "user", "q4"), (4, 1, "assistant", "a4"), (None, 0, "user", "x"),
            (6, 0, "user", "q"), (6, 1, "assistant", "same"), (7, 0, "user", "q"), (7, 1, "assistant", "same")]
    made = chat.format_preferences(chat.reply_pairs(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")))
    got = {r.pair_id: (r.n_prompt_turns, r.prompt, r.chosen, r.rejected) for r in made.collect()}
    user, reply = lambda t: turn("user", t), lambda t: turn("assistant", t)
    assert got == {0: (1, user("q0"), reply("a0"), reply("a1")), 1: (1, user("q1"), reply("a1"), reply("a0")),
                   2: (1, user("nobody answers"), "", ""), 4: (1, user("q4"), reply("a4"), ""),
                   6: (2, user("q") + reply("same"), "", ""), 7: (2, user("q") + reply("same"), "", "")}


def test_empty_tables(spark):
    assert chat.format_preferences(spark.createDataFrame([], SCHEMA)).count() == 0
    assert chat.reply_pairs(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0

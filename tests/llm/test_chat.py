import hashlib

from usagelens.llm import chat

ROWS = [
    (1, 0, "system", "be brief"),
    (1, 2, "assistant", "a\\b <|end|> [INST]"),
    (1, 1, "user", "<|turn|>user<|said|>\n</s>"),
    (2, 0, "user", None),
    (2, 0, "user", None),
    (2, None, None, "first, without role"),
    (None, 0, "assistant", "no id <| \\<| <<SYS>> é 👍"),
    (3, 0, "a<|b\nc", "x" * 200_000),
    (4, 0, "assistant", ""),
]
SCHEMA = "conv_id long, turn long, role string, text string"
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as formatted", "1 as position")


def ordered(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, t) for *_, r, t in sorted(own)] for conv, own in found.items()}


def test_escape_is_reversible_and_leaves_no_control_string():
    texts = [*CONTROL, "\\", "\\\\<|", "<\\|", "<<|", "<|<|", "[[INST]]", "a\\<|\\", "<</s>>", "plain"]
    for a in texts:
        for b in texts:
            made = chat.escape(a + b)
            assert chat.unescape(made) == a + b
            assert not any(c in made for c in CONTROL)


def flattened(texts, role="assistant"):
    parts = [{"type": "text", "text": t} for t in texts]
    return chat.Flattener().turn(role, parts)


def test_control_strings_cut_between_text_parts():
    """Every control string, and the template's own, cut at every place and at every two places."""
    strings = [*CONTROL, chat.TURN, chat.SAID, chat.END, "\\<|end|>", "<|image:0|>", chat.END + chat.TURN + "user" + chat.SAID]
    for whole in strings:
        for i in range(len(whole) + 1):
            for j in range(i, len(whole) + 1):
                texts = ["x" + whole[:i], whole[i:j], whole[j:] + "y"]
                turn = flattened(texts)
                assert chat.read_back(turn["formatted"]) == [("assistant", f"x{whole}y")]
                inside = turn["formatted"][len(chat.TURN + "assistant" + chat.SAID) : -len(chat.END)]
                assert not any(c in inside for c in CONTROL)
                spans = [turn["formatted"][s["start"] :][: s["length"]] for s in turn["loss"]]
                assert "".join(spans) == inside and chat.unescape("".join(spans)) == f"x{whole}y"
                assert len(spans) == 2 + (j > i)


def test_texts_around_attachments_and_empty_texts():
    image = {"type": "image", "ref": "r", "width": 28, "height": 28}
    texts = ["<", None, "|end|>", "", "["]
    parts = [{"type": "text", "text": t} for t in texts] + [image, {"type": "text", "text": "INST]"}]
    turn = chat.Flattener().turn("user", parts)
    assert chat.read_back(turn["formatted"]) == [("user", "<|end|>[INST]")]
    assert "[INST]" not in turn["formatted"] and turn["formatted"].count(chat.END) == 1
    assert turn["loss"] == []


def test_formatted_text_reads_back(spark):
    found = {}
    for r in chat.format_conversations(table(spark)).orderBy("conv_id", "position").collect():
        found.setdefault(r.conv_id, []).append(r)
    want = ordered(ROWS)
    assert found.keys() == want.keys()
    for conv, rows in found.items():
        whole = "".join(r.formatted for r in rows)
        assert chat.read_back(whole) == want[conv]
        assert [r.start for r in rows] == [sum(len(q.formatted) for q in rows[:i]) for i in range(len(rows))]
        masked = [chat.unescape(whole[s.start : s.start + s.length]) for r in rows for s in r.loss]
        assert masked == [t for role, t in want[conv] if role == "assistant" and t]


def test_digests(spark):
    def hexed(text):
        return hashlib.sha256(text.encode()).hexdigest()

    found = {r.conv_id: r for r in chat.conversation_digests(table(spark)).collect()}
    want = ordered(ROWS)
    assert found.keys() == want.keys()
    for conv, turns in want.items():
        said = "".join(t for role, t in turns if role == "assistant")
        r = found[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hexed("".join(f"{role}\n{text}\n" for role, text in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(said), hexed(said))
        marks = len(chat.TURN + chat.SAID + chat.END)
        assert r.formatted_chars == sum(
            marks + len(chat.escape(role)) + len(chat.escape(text)) for role, text in turns
        )
    assert chat.conversation_digests(table(spark).limit(0)).count() == 0
    assert chat.format_conversations(table(spark).limit(0)).count() == 0


def test_parts_become_ordered_placeholders(spark):
    def part(type, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
        return (type, text, ref, width, height, seconds, pages)

    rows = [
        (1, 0, "user", "unused", [part("text", "see "), part("image", None, "a.png", 56, 29), part("text", " ok")]),
        (1, 1, "assistant", None, [part("text", "hear"), part("audio", None, "b.wav", seconds=2.0), part("text", "!")]),
        (1, 2, "user", None, [part("document", None, "c.pdf", pages=3), part("hologram", None, "d"), None]),
        (1, 3, "user", "plain", None),
        (1, 4, "user", "unused", []),
        (2, 0, "user", None, [part("image", None, None)]),
    ]
    df = spark.createDataFrame(rows, f"{SCHEMA}, parts array<{chat.PART}>")
    found = chat.format_conversations(df, parts_col="parts").orderBy("conv_id", "position").collect()
    said = [r.formatted.removeprefix(f"{chat.TURN}{r.role}{chat.SAID}").removesuffix(chat.END) for r in found]
    assert said == [
        "see <|image:0|> ok", "hear<|audio:1|>!", "<|document:2|><|other:3|>", "plain", "", "<|image:0|>",
    ]
    attached = [(a.number, a.type, a.ref, a.tokens) for r in found for a in r.attachments]
    assert attached == [
        (0, "image", "a.png", 4), (1, "audio", "b.wav", 25), (2, "document", "c.pdf", 3072),
        (3, "other", "d", 0), (0, "image", None, 0),
    ]
    whole = "".join(r.formatted for r in found if r.conv_id == 1)
    for r in found[:5]:
        for a in r.attachments:
            assert whole[a.start :].startswith(f"<|{a.type}:{a.number}|>")
    assert [whole[s.start : s.start + s.length] for s in found[1].loss] == ["hear", "!"]
    assert chat.read_back(whole)[1] == ("assistant", "hear!")

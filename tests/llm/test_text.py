"""Chat formatting, token files, pieces and personal data: round trips and brute force."""

from __future__ import annotations

import hashlib
import io
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from serieslake.llm import chat_format, pieces, pii, token_files
from serieslake.llm.queries import END_ID, PROBE, vocabulary

TRICKY = [
    "plain",
    "",
    None,
    PROBE,
    "<\\/s> <\\\\/s> </s></s> <|turn|><|says|>",
    "ends with <",
    "</s",
    "[[INST] [\\INST] \\",
    "é漢字𝄞 \n\t tail  ",
    "$1 \\$2",
]


def chats(spark, rows):
    kinds = "conv_id long, turn long, role string, text string, said string, ends int"
    return spark.createDataFrame([(*row, "s", 1) for row in rows], kinds)


def test_chat_round_trip(spark):
    rows = []
    for conv in range(4):
        for turn, text in enumerate(TRICKY):
            role = ("system", "user", "assistant", "user")[(turn + conv) % 4]
            rows.append((conv, turn, role, text))
    rows += [(10, 0, "user", "only a question"), (11, 0, "assistant", "first"), (11, 0, "assistant", "first")]
    rows += [(12, None, None, "no turn"), (12, 1, "we<|says|>ird", "x"), (None, 1, "assistant", "null id")]
    rows += [(13, 0, "assistant", ""), (14, 5, "user", "long " * 20000), (14, 7, "assistant", "reply")]
    examples = chat_format.format_chats(chats(spark, rows))
    read = examples.select(
        "conv_id",
        "example",
        "of",
        "formatted",
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss().alias("loss"),
    ).collect()
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, said in want.items():
        said.sort()
        own = sorted((r for r in read if r.conv_id == conv), key=lambda r: r.example)
        assert [r.example for r in own] == list(range(own[0].of))
        targets = [k for k, t in enumerate(said) if t[2] == "assistant"]
        ends = targets + ([len(said) - 1] if said[-1][2] != "assistant" else [])
        assert len(own) == len(ends)
        for r, end in zip(own, ends):
            assert [(t.role, t.text) for t in r.turns] == [t[2:] for t in said[: end + 1]]
            assert r.loss == (said[end][3] if end in targets else "")
            assert r.formatted.count("</s>") == end + 1 == r.formatted.count("<|turn|>")
            assert "[INST]" not in r.formatted


def test_chat_empty(spark):
    assert chat_format.format_chats(chats(spark, [])).count() == 0


def test_template_refuses_ambiguous_controls():
    with pytest.raises(ValueError):
        chat_format.Template(foreign=("<<SYS>>",))


def texts():
    rng = random.Random(3)
    words = ["the", "The,", "naïve", "don't", "it's!!", "x<|endoftext|>y", "foo's.", "ÉTÉ", "a.b", "1,234.5", "|", "***"]
    made = [" ".join(rng.choice(words) + rng.choice(["", ".", "!!", "\n"]) for _ in range(60)) for _ in range(40)]
    odd = ["", None, "  ", "a", "\x1cx\x85y\xa0z", "é a̸", "x" * 5000, "İstanbul ΣΑΣ", "😀 ok", "tab\there\x0bnow", "the " * 30000]
    return [(k * 7 % 101, t) for k, t in enumerate(made + odd)] + [(None, "null id"), (3, "again"), (3, "again")]


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = texts()
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, start int")
    files = token_files.write_token_files(docs, str(tmp_path / "t"), path, END_ID)
    got = token_files.read_token_files(files, str(tmp_path / "t")).collect()
    want = []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, END_ID], "<u4")
        want.append((i is not None, i or 0, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == list(np.cumsum([0] + [r.n_tokens for r in ordered])[:-1])
    ids = [r.doc_id if r.doc_id is not None else -1 for r in ordered]
    assert ids == sorted(ids)


MARKS = ("\u030c", "\u0331", "\u0308", "\u030a", "\u0344", "\u0331\u0307")


def test_words_keep_their_case_where_it_matters():
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = ["<|ENDOFTEXT|>", "a<|EndOfText|>b", "<|endoftext|> <|ENDOFTEXT|>. <|StartOfText|>x", "The <| END |> <|", "THE the The."]
    texts += [f"{letter}{mark} x{letter}{mark}y. {letter.lower()}{mark}" for letter in "HJTWYIAK" for mark in MARKS]
    rng = random.Random(5)
    parts = ["<|", "|>", "EndOfText", "endoftext", "STARTOFTEXT", "<|endoftext|>", " ", "J", "t", *MARKS]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(500)]
    encoder = token_files.WordEncoder(path)
    ids, counts = encoder.encode([text.encode() for text in texts])
    ends = np.cumsum(counts)
    for text, low, high in zip(texts, ends - counts, ends):
        assert ids[low:high].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_token_files_empty(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    files = token_files.write_token_files(docs, str(tmp_path / "t"), vocabulary("word_bpe_49k.json"), END_ID)
    assert files.count() == 0
    assert token_files.read_token_files(files, str(tmp_path / "t")).count() == 0


class Bytes:
    """A source that counts what is read."""

    def __init__(self, body):
        self.body, self.read = body, 0

    def size(self):
        return len(self.body)

    def read_at(self, count, place):
        self.read += count
        return self.body[place : place + count]


def test_frames_seek_and_verify(monkeypatch):
    import zstandard

    monkeypatch.setattr(token_files, "FRAME_BYTES", 4096)
    rng = np.random.default_rng(1)
    documents = [rng.integers(0, 49000, n).astype("<u4").tobytes() for n in (0, 5, 3000, 1, 700, 900, 0, 20000)]
    sink = io.BytesIO()
    writer = token_files.TokenFileWriter(sink)
    for k, body in enumerate(documents):
        writer.add(None if k == 3 else k * 10, body)
    writer.close()
    file = token_files.TokenFile(Bytes(sink.getvalue()))
    assert file.ids == [0, 10, 20, None, 40, 50, 60, 70] and list(file.documents()) == documents
    assert len(file.sizes) > 3
    before = file.source.read
    assert file.document(4) == documents[4]
    assert file.source.read - before < len(sink.getvalue()) / 4
    whole = zstandard.ZstdDecompressor().stream_reader(sink.getvalue(), read_across_frames=True).read()
    assert whole == b"".join(documents)
    broken = bytearray(sink.getvalue())
    broken[len(broken) - 9 - 12 * len(file.sizes) + 8] ^= 1  # the first frame's sum
    with pytest.raises(ValueError):
        list(token_files.TokenFile(Bytes(bytes(broken))).documents())


def test_pieces_match_lattice_and_round_trip(spark):
    """Every unit scores as well as the public library's best lattice path over the same pieces."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    path = vocabulary("piece_bpe_32k.model")
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(path, "rb").read())
    model.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    known = pieces.vocabulary_of(path)
    samples = ["the with", "naïve café", "", None, " lead", "a  b   c\n\nd ", "漢字𝄞 ok", "x" * 300, "e" * 6000, "1234567", "über-groß", "def f(x):\n    return x"]
    docs = spark.createDataFrame(
        [(k, t, "u") for k, t in enumerate(samples)] + [(0, samples[0], "u"), (None, "null id", "u")],
        "doc_id long, text string, unit string",
    )
    for remembered in (2, 1000):
        encoded = pieces.encode_documents(docs, path, remembered=remembered)
        rows = encoded.withColumn("back", pieces.decoded(F.col("ids"), path)).collect()
        assert len(rows) == len(samples) + 2
        for r in rows:
            text = "null id" if r.doc_id is None else samples[r.doc_id] or ""
            assert r.back == text
            assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
            if text and len(text) < 40:
                best = library.nbest_encode_as_ids(text, 2)[0]
                assert score(known, r.ids) >= score(known, best) - 1e-6


def score(known, ids):
    """Of a path; a character in bytes costs the unknown score once."""
    total, k, reverse = 0.0, 0, {v: b for b, v in known.bytes.items()}
    while k < len(ids):
        if ids[k] in reverse:
            lead = reverse[ids[k]]
            k += 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            total += known.unknown
        else:
            total += known.scores.get(ids[k], known.unknown)
            k += 1
    return total


def test_pieces_best_path_by_brute_force(spark):
    path = vocabulary("piece_bpe_32k.model")
    known = pieces.vocabulary_of(path)
    by_piece = {known.pieces[k]: known.scores[k] for k in known.normal}
    units = [" the", "inter", " of", "anties", " 12", "é", "\n", " zqx", "   "]

    def best(text):
        if not text:
            return 0.0
        scores = []
        for n in range(1, min(known.longest, len(text)) + 1):
            own = by_piece.get(text[:n], known.unknown if n == 1 else None)
            if own is not None:
                scores.append(own + best(text[n:]))
        return max(scores)

    got = pieces.encode_units(spark.createDataFrame([(u,) for u in units], "unit string"), path)
    rows = got.collect()
    assert len(rows) == len(units)
    for r in rows:
        assert score(known, r.ids) == best(r.unit.replace(" ", pieces.MARK))

def test_pieces_reach_is_the_longest_piece(spark):
    """Every place is one row of the lattice, with the longest piece that ends there."""
    path = vocabulary("piece_bpe_32k.model")
    known = pieces.vocabulary_of(path)
    whole = {known.pieces[k].replace(pieces.MARK, " ") for k in known.normal}
    units = [" the", "internationalization", " of", "anties", " 12", "é", "漢𝄞字", "\n", "zqx", " " * 20]
    wanted = [
        max([n for n in range(1, end + 1) if unit[end - n : end] in whole], default=1)
        for unit in units
        for end in range(1, len(unit) + 1)
    ]
    reach, lengths = known.reach(units)
    assert reach.tolist() == wanted and lengths.tolist() == [len(unit) for unit in units]
    table = {r.piece: r.scores for r in pieces.piece_table(spark, path).collect()}
    by_piece = {known.pieces[k]: known.scores[k] for k in known.normal}
    for piece in [pieces.MARK + "the", *list(by_piece)[::997]]:
        ends = [by_piece.get(piece[-n:], known.unknown if n == 1 else None) for n in range(1, len(piece) + 1)]
        assert table[piece] == ends


def brute_plain(text):
    """The contract's patterns as they stand."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c in "0123456789"]
        doubled = [d * 2 if k % 2 else d for k, d in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in out)


def test_plain_spans_match_patterns():
    rng = random.Random(11)
    parts = ["a@b.c", "@", ".", "1.2.3.4", "5.6.7.8.9", "256.1.1.1", "001.2.3.04", "4111 1111 1111 1111", "4111111111111111",
             "4111-1111-1111-1112", "+1 (555) 123-4567", "+", "+12", " ", "-", "x", "0", "12345678901234567890", "a@b", "x@y.z@w.v", "é", "٣"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        assert pii.joined(pii.plain_spans(text)) == brute_plain(text), text


@pytest.mark.parametrize(
    ("text", "kind", "hidden"),
    [
        ("mail john (at) example [dot] com now", "email", "john (at) example [dot] com"),
        ("write jane at example dot org today", "email", "jane at example dot org"),
        ("ｊｏｅ＠ｘｙ.ｃｏｍ", "email", "ｊｏｅ＠ｘｙ.ｃｏｍ"),
        ("see jо​e@site.com", "email", "jо​e@site.com"),
        ("call plus one five five five one two three four now", "phone", "plus one five five five one two three four"),
        ("card 4111 1111 1111 1111.", "card", "4111 1111 1111 1111"),
        ("host 10 dot 0 dot 0 dot 7 up", "ip", "10 dot 0 dot 0 dot 7"),
        ("٤111 1111 1111 1111", "card", "٤111 1111 1111 1111"),
    ],
)
def test_disguises(text, kind, hidden):
    plain, everything = pii.find_spans(text)
    added = set(everything[kind]) - set(plain[kind])
    assert [text[s:e] for s, e in added] == [hidden]


@pytest.mark.parametrize(
    "text", ["", "we met at noon. It was one of two or three things", "dot at dot", "at home dot", "été — à 10 h", "one two three go"]
)
def test_clean_text_stays_clean(text):
    assert pii.joined(pii.find_spans(text)[1]) == ""


TWINS = {
    **dict.fromkeys("\u0435\u0415\u03b5\u0395", "e"),
    **dict.fromkeys("\u043a\u041a\u03ba\u039a", "k"),
    **dict.fromkeys("\u0442\u0422\u03c4\u03a4", "t"),
    **dict.fromkeys("\u043d\u041d\u0397", "h"),
    **dict.fromkeys("\u043c\u041c\u039c", "m"),
    **dict.fromkeys("\u0443\u0423\u03a5", "y"),
    **dict.fromkeys("\u0445\u0425\u03c7\u03a7", "x"),
    **dict.fromkeys("\u0430\u0410\u03b1\u0391", "a"),
    **dict.fromkeys("\u043e\u041e\u03bf\u039f", "o"),
    **dict.fromkeys("\u0440\u0420\u03c1\u03a1", "p"),
    **dict.fromkeys("\u0441\u0421\u03f2", "c"),
    **dict.fromkeys("\u0456\u0406\u03b9\u0399", "i"),
    **{"\u0432": "b", "\u0412": "b", "\u0392": "b", "\u0455": "s", "\u0405": "s", "\u0458": "j"},
    **{"\u0408": "j", "\u0501": "d", "\u04bb": "h", "\u0433": "r", "\u04cf": "l", "\u0475": "v"},
    **{"\u051b": "q", "\u051d": "w", "\u03c5": "u", "\u03bd": "v", "\u03b7": "n", "\u039d": "n"},
    **{"\u0396": "z"},
}


@pytest.mark.parametrize("letter", sorted(TWINS), ids=lambda letter: f"{ord(letter):04X}")
def test_every_twin_inside_an_address(letter):
    text = f"write to jo{letter}n@si{letter}te.com today"
    _, everything = pii.find_spans(text)
    assert everything["email"] == [(9, len(text) - 6)]
    assert pii.normalise(letter)[0].lower() == TWINS[letter]


def test_small_ie_is_undone():
    text = "jo\u0435@sit\u0435.com"
    assert pii.find_spans(text)[1]["email"] == [(0, len(text))]


@pytest.mark.parametrize(
    ("text", "kind", "hidden"),
    [
        ("mail john  at   example\tdot com now", "email", "john  at   example\tdot com"),
        ("mail john at mail.example dot com now", "email", "john at mail.example dot com"),
        ("host one zero dot zero dot zero dot one up", "ip", "one zero dot zero dot zero dot one"),
        ("host one [dot] two (dot) 3 dot  four.", "ip", "one [dot] two (dot) 3 dot  four"),
        ("call plus one, five, five, five, one, two, three, four now", "phone", "plus one, five, five, five, one, two, three, four"),
        ("jane at one dot org", "email", "jane at one dot org"),
    ],
)
def test_wider_disguises(text, kind, hidden):
    plain, everything = pii.find_spans(text)
    added = set(everything[kind]) - set(plain[kind])
    assert [text[s:e] for s, e in added] == [hidden]


@pytest.mark.parametrize("text", ["look at example.com", "one, two and three dots", "one dot two dot three", "a  dot\nplot at noon"])
def test_prose_stays_clean(text):
    assert pii.joined(pii.find_spans(text)[1]) == ""


def test_plain_spans_always_stay():
    text = "a@b.co (at) c@d.eu dot x 4111 1111 1111 1111 ＋1 555 1234567"
    plain, everything = pii.find_spans(text)
    assert all(span in everything[kind] for kind in plain for span in plain[kind])


def test_long_runs_are_quick():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "@" * 100_000, "+1" + " " * 100_000):
        pii.find_spans(text)


def test_personal_data_frame(spark):
    rows = [(1, "a@b.co and 1.2.3.4"), (2, None), (None, ""), (3, "x (at) y dot z"), (1, "a@b.co and 1.2.3.4")]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, spans int")
    got = {(r.doc_id, r.n_email, r.n_ip, r.spans, r.base_sha256) for r in pii.find_personal_data(docs).collect()}
    assert (1, 1, 1, "email:0:6,ip:11:18", hashlib.sha256(b"email:0:6,ip:11:18").hexdigest()) in got
    assert (3, 1, 0, "email:0:14", hashlib.sha256(b"").hexdigest()) in got
    assert (None, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got and len(got) == 4
    assert pii.find_personal_data(docs.where("false")).count() == 0

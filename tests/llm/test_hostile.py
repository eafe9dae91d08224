"""Texts and templates made to crash or stall the training-data operators."""

import random
import struct
import time

from tallyforge.llm import chat, media, secret_scan

ALL_PRIVATE = "".join(map(chr, range(0xE000, 0xF900)))


def alternating(turns):
    for i, (role, _) in enumerate(turns):
        if role != ("user", "assistant")[i % 2]:
            raise ValueError("roles must alternate")
    return "".join(f"<{r}>{t}\n" for r, t in turns)


def looks_at_first(turns):
    return f"[{turns[0][0]} first]" + "".join(f"{r}: {t}\n" for r, t in turns)


def pairs_only(turns):
    if len(turns) % 2:
        raise RuntimeError("pairs only")
    return "".join(f"{r}: {t}\n" for r, t in turns)


def test_chat_of_texts_with_every_private_character():
    done = chat.spans_of([("user", ALL_PRIVATE), ("assistant", "yes " + ALL_PRIVATE)])
    a, b = done.texts[1]
    assert chat.unescape(done.text[a:b]) == "yes " + ALL_PRIVATE
    every = "".join(map(chr, [*range(0xE000, 0xF900), *range(0xF0000, 0xFFFFE), *range(0x100000, 0x10FFFE)]))
    done = chat.spans_of([("user", "a"), ("assistant", every)])
    assert done.texts[1] is None and not done.rewrites and done.error is None


def test_templates_that_raise_are_told_and_end_nothing():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    done = chat.spans_of(turns, looks_at_first)
    assert not done.rewrites and [done.text[a:b] for a, b in done.texts] == list("abcd") and done.spans[0][0] == 0
    done = chat.spans_of(turns[:2] + [("assistant", "e")], alternating)
    assert done.error == "ValueError: roles must alternate" and done.text == alternating(turns[:2]) and done.texts[2] is None
    done = chat.spans_of(turns, pairs_only)
    assert done.error is None and done.text == pairs_only(turns) and done.texts[0] is None and done.text[slice(*done.texts[3])] == "d"
    assert done.spans == [(0, 0), (0, 21), (21, 21), (21, 42)]
    assert chat.spans_of(turns, lambda t: None).error.startswith("TypeError")
    assert chat.spans_of([], alternating).text == ""


def test_a_job_goes_on_after_a_refused_conversation(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "assistant", "x"), (2, 1, "user", ALL_PRIVATE), (3, 0, "user", "q"), (3, 1, "user", "r")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")

    def template(turns):
        if any(role != ("user", "assistant")[i % 2] for i, (role, _) in enumerate(turns)):
            raise ValueError("roles must alternate")
        return "".join(f"<{r}>{t}\n" for r, t in turns)

    got = {r.conv_id: r for r in chat.format_conversations(df, template).collect()}
    assert [got[i].error is None for i in (1, 2, 3)] == [True, False, False]
    assert got[1].formatted == "<user>a\n<assistant>b\n" and got[2].formatted == "" and got[2].unlocated == 1
    assert got[3].formatted == "<user>q\n" and got[3].turns == 2
    whole = chat.read_back(chat.format_conversations(df)).collect()
    assert {r.conv_id: r.n_turns for r in whole} == {1: 2, 2: 2, 3: 2}


def test_secret_scan_of_repeated_prefixes(spark):
    prefixes = ["eyJ", "eyJaaaaaaaa.", "eyJaaaaaaaa.eyJ", "token", "token=", "password\"' ", "AKIA", "ghp_", "xoxb-", "AIza", "sk_live_", "-----BEGIN ", "-----BEGIN PRIVATE KEY", "a", "="]
    rows = [(i, p * (200_000 // len(p))) for i, p in enumerate(prefixes)] + [(99, "x eyJ" + "a" * 20 + ".eyJ" + "b" * 20 + "." + "c" * 20 + " y")]
    begin = time.time()
    got = {r.doc_id: r for r in secret_scan.digest(secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert time.time() - begin < 90
    assert got[99].spans == "jwt:2:70" and len(got) == len(rows)


def test_tokens_beside_tokens(spark):
    head, part = "eyJ" + "a" * 9, "eyJ" + "b" * 9
    cases = {
        f"{head}.{part}.short {head}.{part}.{'c' * 9}": [(36, 70)],
        f"{head}.{part}.{part}.{part}": [(0, 38)],
        f"eyJ.{head}.{part}.{'c' * 8}": [(4, 37)],
        f"eyJeyJ{head}.{part}.{'c' * 8}": [(0, 39)],
        f"{head}.x{part}.{'c' * 8}": [],
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x.startswith("jwt")] for r in secret_scan.digest(secret_scan.scan(df)).collect()}
    import re

    plain = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
    for i, t in enumerate(cases):
        assert got[i] == [m.span() for m in plain.finditer(t)], t


def plain_wav(raw, at):
    """The validator as a walk of its own for each file."""
    if at + 12 > len(raw) or raw[at + 8 : at + 12] != b"WAVE":
        return 0
    end = at + 8 + int.from_bytes(raw[at + 4 : at + 8], "little")
    if end > len(raw):
        return 0
    chunk, seen = at + 12, set()
    while chunk + 8 <= end:
        seen.add(raw[chunk : chunk + 4])
        size = int.from_bytes(raw[chunk + 4 : chunk + 8], "little")
        chunk += 8 + size + size % 2
    return end - at if chunk in (end, end + 1) and {b"fmt ", b"data"} <= seen else 0


def plain_gif(b, at):
    if at + 14 > len(b):
        return 0
    place = at + 13 + (3 << (b[at + 10] & 7) + 1 if b[at + 10] & 0x80 else 0)

    def blocks(place):
        while place < len(b) and b[place]:
            place += 1 + b[place]
        return place + 1

    images = 0
    while place < len(b):
        if b[place] == 0x3B:
            return place + 1 - at if images else 0
        if b[place] == 0x21:
            place = blocks(place + 2)
        elif b[place] == 0x2C and place + 10 < len(b):
            place = blocks(place + 11 + (3 << (b[place + 9] & 7) + 1 if b[place + 9] & 0x80 else 0))
            images += 1
        else:
            return 0
    return 0


def test_media_walks_that_share_places_equal_walks_of_their_own():
    rng = random.Random(5)
    hits = 0
    for _ in range(4000):
        parts = []
        for _ in range(rng.randint(1, 14)):
            body = bytes(rng.choices([0, 1, 2, 3, 8, 0x21, 0x2C, 0x3B, 65], k=rng.randint(0, 9)))
            k = rng.randrange(6)
            if k == 0:
                parts.append(rng.choice([b"fmt ", b"data", b"LIST"]) + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2))
            elif k == 1:
                parts.append(b"RIFF" + struct.pack("<I", rng.randint(0, 80)) + b"WAVE")
            elif k == 2:
                inner = b"".join(rng.choice([b"fmt ", b"data"]) + struct.pack("<I", 2) + b"ab" for _ in range(rng.randint(1, 4)))
                parts.append(b"RIFF" + struct.pack("<I", 4 + len(inner) + rng.choice([0, 0, 0, 10])) + b"WAVE" + inner)
            elif k == 3:
                parts.append(b"GIF89a" + bytes([1, 0, 1, 0, rng.choice([0, 0x80]), 0, 0]) + bytes(6))
            elif k == 4:
                parts.append(b"\x2c" + bytes(9) + b"\x02\x02aa\x00" + rng.choice([b"\x3b", b""]))
            else:
                parts.append(body)
        raw = b"".join(parts)
        value = media.Value(raw)
        for at in range(len(raw)):
            if raw[at : at + 4] == b"RIFF":
                assert media._wav(value, at) == plain_wav(raw, at)
                hits += media._wav(value, at) > 0
            if raw[at : at + 3] == b"GIF":
                assert media._gif(value, at) == plain_gif(raw, at)
                hits += media._gif(value, at) > 0
    assert hits > 500


def test_media_of_nested_headers_and_plain_text():
    machine = media.automaton()
    n = 400_000
    nested = bytearray()
    while len(nested) < n:  # each header claims all the rest and is a chunk of the one before
        nested += b"RIFF" + struct.pack("<I", n) + b"WAVE"
    inside = b"".join(b"RIFF" + struct.pack("<I", max(0, n - 20 * i - 8)) + b"WAVEdata" + struct.pack("<I", 4) for i in range(n // 20))
    texts = [bytes(nested), inside, b"GIF89a Hello, world! " * (n // 21), b"GIF89a" * (n // 6), b"GIF89a1234567!,!,!,!," * (n // 21), b"RIFF0000WAVEfmt 0000" * (n // 20)]
    for raw in texts:
        begin = time.process_time()
        media.sniff(raw, machine)
        assert time.process_time() - begin < 10

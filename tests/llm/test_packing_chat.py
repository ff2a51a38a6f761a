"""Packing against the public tokenizer and all cuts; chat formatting as an exact round trip."""

import hashlib
import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from squadlake.llm import chat, packing
from squadlake.llm.tokens import WordEncoder


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


TEXTS = [
    "", " ", "a", " a", "a ", "The cat  sat.\n\nOn 3 mats!", "don't we'll", "x\ty z\n w", "\n", "tab \t", "nul\x00 in it",
    "Ünïcödé 漢字 🙂 ok", "<|endoftext|> is text", "nb sp and   em", "a\x1cb \x1d c", "word " * 300, "?" * 200,
]


def test_ids_are_those_of_the_tokenizer(reference):
    encoder = WordEncoder()
    for texts in (TEXTS, TEXTS[::-1]):
        assert [x.tolist() for x in encoder.encode(texts)] == [reference(t) for t in texts]


@given(st.lists(st.text(alphabet="ab .\n'és1", max_size=40), max_size=6))
def test_ids_of_any_text(texts):
    encoder = WordEncoder()
    assert [x.tolist() for x in encoder.encode(texts)] == [encoder.encoding.encode_ordinary(t) for t in texts]


def test_an_added_token_is_one_id(documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    texts = ["a <|endoftext|> b", "One.<|endoftext|>", "<|endoftext|>" * 3 + "\n\n x  ", "<|endoftext| >", "plain"]
    assert ids(texts[0]) == [64, 220, 50256, 275]
    rows = packing.pack_documents(documents(texts)).collect()
    assert {r.doc_id: r.input_ids for r in rows} == {n: [*ids(t), packing.SEPARATOR] for n, t in enumerate(texts)}
    assert check_pieces(rows, dict(enumerate(texts)), ids) < 100


def cost_of(cuts, price, window):
    start = total = 0
    for cut in cuts:
        size = cut - start
        if not 0 < size <= window:
            return None
        total += (0 if size & (size - 1) == 0 else window - size) + price[cut]
        start = cut
    return total


def test_cuts_cost_the_least():
    pick = random.Random(7)
    for _ in range(60):
        points = sorted(pick.sample(range(1, 60), 8))
        price = {p: pick.choice([0, 2, 9]) for p in points}
        window = pick.choice([16, 20, 32])
        gaps = [b - a for a, b in zip([0, *points], points)]
        if max(gaps) > window:
            continue
        cuts = packing.choose_cuts(np.array(points), np.array([price[p] for p in points]), window)
        all_ways = [
            cost_of([*some, points[-1]], price, window) for n in range(8) for some in combinations(points[:-1], n)
        ]
        assert cost_of(cuts, price, window) == min(c for c in all_ways if c is not None)


def check_pieces(rows, texts, reference, window=packing.WINDOW):
    """Every id in exactly one piece, sequences without gaps and within the window. Returns the padding."""
    ids = {i: np.array([*reference(t or ""), 0], np.uint32) for i, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            piece = ids[doc][r.start : r.start + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids[doc]), zlib.crc32(piece.tobytes()))
            at += r.length
        assert at == len(ids[doc])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / sum(map(len, ids.values()))


def test_packing_of_the_documents(spark, reference):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert check_pieces(packing.packing_digest(docs).collect(), texts, reference) < 0.03


def test_packing_of_odd_documents(documents, empty, reference):
    texts = {0: None, 1: "", 2: "word " * 9_000, 3: "x" * 50_000, 4: "One. Two."}
    rows = packing.pack_documents(documents(list(texts.values()))).collect()
    check_pieces(rows, texts, reference)
    assert sum(map(len, (r.input_ids for r in rows))) == sum(r.length for r in rows)
    again = packing.packing_digest(documents(["same", "same"], [None, None])).collect()
    assert [r.doc_id for r in again] == [None, None] and packing.packing_digest(empty).count() == 0


@given(st.text(alphabet="<|\\>im_startend\n ok", max_size=40))
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


@given(st.text(max_size=30).filter(lambda t: t.isprintable() or not t), st.sampled_from(["user", "assistant", "", "<|im_end|>"]))
def test_a_turn_is_read_back(text, role):
    ids, mask = chat.turn_tokens(role, text)
    back_role, back, learnt, shown = chat.read_back(ids, mask)
    assert (back_role, back, learnt) == (role, text, text if role == "assistant" else "")
    assert shown.startswith("<|im_start|>") and shown.endswith("<|im_end|>\n") and shown.count("<|") == 2


def test_conversations_in_odd_shapes(spark):
    schema = "conv_id long, turn long, role string, text string, input_ids string"
    rows = [(5, 1, "assistant", None, "x"), (5, 0, None, "b", "x"), (5, 1, "assistant", "t" * 5_000, "x"),
            (None, 0, "user", "n", "x"), (6, None, "assistant", "z", "x"), (6, 0, "assistant", "z", "x"), (6, 0, "assistant", "z", "x")]
    got = {r.conv_id: r for r in chat.chat_digest(spark.createDataFrame(rows, schema)).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert got[5].turns_sha256 == sha(f"\nb\nassistant\n\nassistant\n{'t' * 5_000}\n")
    assert (got[5].loss_chars, got[5].loss_sha256) == (5_000, sha("t" * 5_000))
    assert (got[6].n_turns, got[6].loss_sha256) == (3, sha("zzz"))
    assert got[None].n_turns == 1 and got[-1].loss_sha256 == sha("<|im_end|><|im_start|>assistant ok")
    assert chat.chat_digest(spark.createDataFrame([], schema)).count() == 1

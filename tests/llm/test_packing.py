import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loadstar.llm import packing, tokens

from .helpers import docs

PATHS = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json",
                                             "word_bpe_49k.json")]
ODD = ["", " ", "a  b", " a", "a \n b", "x\n\ny. z,", "\n", "a,\nb.\nc d",
       "don't, we'll. ok...", "é,\xa0b  c　 d", "a\x1cb \x85c",
       "Σ. ΑΣ, ΟΔΟΣ x", "1,2. 3.", "a\r\nb c", "<|endoftext|> b <|endoftext|>",
       "a .b ,c", "\t a\tb \t c", "é ́x a", "日本語 テキスト。 x",
       "x" * 300 + " " + "y." * 60, "İ I, K. ß.", "à la carte, Ñandú. Über",
       "the the, the. the\nthe " * 40]


def truth(path, text):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", PATHS)
def test_encoder_gives_the_library_s_ids(path):
    enc = tokens.Encoder(path)
    for text in [*ODD, " ".join(ODD), *ODD]:
        got = np.frombuffer(enc.encode(text), "<u4").tolist()
        assert got == truth(path, text), text


def test_encoder_with_a_full_table(monkeypatch):
    monkeypatch.setattr(tokens, "KEEP", 8)
    enc = tokens.Encoder(PATHS[0])
    text = " ".join(f"w{i % 40}x, y{i}." for i in range(300))
    for _ in range(2):
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == truth(
            PATHS[0], text)


def test_lengths_are_powers_of_two():
    for n in range(0, 5000, 7):
        ls = packing.lengths(n, 2048)
        assert sum(ls) == n and all(x & (x - 1) == 0 and x <= 2048 for x in ls)
        assert ls == sorted(ls, reverse=True)


def test_pieces_hold_every_id_once(spark):
    rows = [(1, "alpha beta gamma " * 900), (2, None), (3, ""), (4, ODD[6]),
            (5, "word"), (5, "word"), (None, "no id"), (7, "é" * 5000)]
    df = docs(spark, rows, extra=("length", "start", "tokens", "offset"))
    got = packing.pack(df, PATHS[0]).collect()
    pieces = {}
    for r in got:
        assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048
        assert len(r["tokens"]) == 4 * r["length"] and r["offset"] == 0
        pieces.setdefault(r["doc_id"], []).append(r)
    for doc, text in rows:
        want = truth(PATHS[0], text) + [1]
        copies = sum(1 for d, _ in rows if d == doc)
        ps = sorted(pieces[doc], key=lambda r: r["start"])
        ids = np.concatenate([packing.unpack(r["tokens"]) for r in ps]).tolist()
        assert len(ids) == copies * len(want)
        if copies == 1:
            assert ids == want
        assert {r["doc_tokens"] for r in ps} == {len(want)}
    seq = sorted(r["sequence_id"] for r in got)
    assert seq == list(range(len(got)))
    # longest bucket first
    by_seq = [r["length"] for r in sorted(got, key=lambda r: r["sequence_id"])]
    assert by_seq == sorted(by_seq, reverse=True)


def test_empty_table_and_bad_length(spark):
    assert packing.pack(docs(spark, []), PATHS[0]).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs(spark, []), PATHS[0], max_len=1000)


def test_packs_the_same_with_few_kept_words(spark):
    df = docs(spark, [(i, f"word{i} and some others, number {i % 5}.")
                      for i in range(40)])
    def got(**kw):
        return sorted(tuple(r) for r in packing.pack(
            df, PATHS[0], **kw).collect())
    assert got(keep=4) == got()


def test_marked_words_are_looked_up_by_their_parts():
    marked = [f"dotaga{m}" for m in ("***", "$$$", ".$$$", "?", "!\"", "-")]
    texts = ["dotaga x " + " ".join(marked) + "\nDotaga: end***",
             "İ, b क़. c İ*** don't. l'", "dotaga**", "a ", "a  b", "\nab c"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        tok, enc = Tokenizer.from_file(path), tokens.Encoder(path)
        for t in texts * 2:
            want = tok.encode(t, add_special_tokens=False).ids
            assert enc.encode(t) == b"".join(
                k.to_bytes(4, "little") for k in want), (name, t)
    enc = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    enc.encode("a dotaga " + " ".join(marked) + " b")
    # the marks' ids are known now, a stem is all that goes to the model
    enc._chunk = None
    enc.encode("a " + " ".join(m.replace("g", "k") for m in marked) + " b")

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import rows
from tributary.llm import tokens

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "\n", "  a", "a  b \n\n c\t", "x\x1cy!\x1d z", "a b 　c", "▁a ▁ b", "<s> </s> <unk>", "<|endoftext|> a <|endoftext|>b",
       "don't we'll", "Ünï ñ 日本 語 😀", "a" * 3000, " " * 500 + "b", "́x​", "\x00\x01", "1 23 456", "THE!! OF!!", "\r\n\r\n a", "\x85 b"]
TEXT = st.text(alphabet=st.sampled_from(list(" \n\t\r\x0b\x1c\x85\xa0 　▁ab'stñ日1!<|>endoftx😀́")), max_size=60)


def ids(encoder, text):
    found = encoder.ids(text)
    return [int.from_bytes(found[i : i + 4], "little") for i in range(0, len(found), 4)]


def test_every_plain_character_is_classed_alike():
    encoder, whole = tokens.ByteLevel(BYTES), Tokenizer.from_file(BYTES)
    for c in map(chr, range(0x3000)):
        if not tokens.ByteLevel.OTHER.search(c):
            text = f"a{c}a 1{c}1 !{c}! {c} {c}{c}  {c}\n{c}a {c}1 {c}! x{c}'s"
            assert ids(encoder, text) == whole.encode(text, add_special_tokens=False).ids, hex(ord(c))


def test_ids_are_the_library_s():
    encoder, whole = tokens.ByteLevel(BYTES), Tokenizer.from_file(BYTES)
    assert encoder.fast is not None
    for text in ODD * 2:
        assert ids(encoder, text) == whole.encode(text, add_special_tokens=False).ids

    @settings(max_examples=400, deadline=None)
    @given(TEXT)
    def check(text):
        assert ids(encoder, text) == whole.encode(text, add_special_tokens=False).ids

    check()


def test_counts_are_the_library_s():
    counter, whole = tokens.Pieces(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert counter.cuts and len(counter.proved) > 30_000
    for text in ODD * 2:
        assert counter.count(text) == len(whole.encode(text)), text

    @settings(max_examples=400, deadline=None)
    @given(TEXT)
    def check(text):
        assert counter.count(text) == len(whole.encode(text))

    check()


def test_what_is_kept_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 5)
    counter = tokens.Pieces(PIECES)
    whole = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = " ".join(f"qx{k}zv" for k in range(50))
    assert counter.count(text) == len(whole.encode(text)) and len(counter.kept) <= 5


def test_proved_strings_are_single_tokens():
    counter, whole = tokens.Pieces(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for piece in list(counter.proved)[::97]:
        if piece.startswith("▁"):
            assert len(whole.encode(piece[1:].replace("▁", " "))) == (1 if len(piece) > 1 else 0)


def test_table(spark):
    whole = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    data = [(1, "a b", 5), (1, "a b", 5), (None, "ñ\n x", 6), (2, None, 7), (3, "", 8), (4, "word " * 5000, 9)]
    df = spark.createDataFrame(data, "doc_id long, text string, n_tokens long")
    expected = [(i, len((t or "").encode()), len(whole.encode(t or ""))) for i, t, _ in data]
    assert rows(tokens.token_counts(df, PIECES)) == sorted(expected, key=repr)
    assert rows(tokens.token_counts(df.limit(0), PIECES)) == []

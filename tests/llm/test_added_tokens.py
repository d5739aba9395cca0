"""Added tokens in texts: ids as encode(text, add_special_tokens=False) of the library gives them."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import AddedToken, Tokenizer

from lexspark.llm import token_binary

LIBRARY = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"
TEXTS = [
    f"{END} begins it", f"a {END} b", f"it ends {END}", END, END * 3, f" {END}\n\n{END} ", f"half {END[:6]}", f"{END[6:]} other half",
    "", "don't é🙂  stop", f"a'{END}s  {END}  't", f"<|<|endoftext{END}|>", f"word{END}word",
]


def chunk(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def by_text(texts, path):
    ids, sizes = token_binary.library_ids(*chunk(texts), path)
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_added_tokens_are_those_of_the_library():
    tokenizer = Tokenizer.from_file(LIBRARY)
    wanted = lambda texts: [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert by_text(["a <|endoftext|> b"], LIBRARY) == [[64, 220, 50256, 275]]
    assert by_text(TEXTS, LIBRARY) == wanted(TEXTS)
    pick = random.Random(1)
    for _ in range(200):
        texts = ["".join(pick.choices([END, "<|", "|>", " ", "\n", "it's", "é", "end", ""], k=pick.randint(0, 8))) for _ in range(6)]
        assert by_text(texts, LIBRARY) == wanted(texts)


@pytest.mark.parametrize("flags", [{}, {"lstrip": True}, {"rstrip": True}, {"single_word": True}, {"normalized": True}])
def test_other_tokenizers_added_tokens(tmp_path, flags):
    tokenizer = Tokenizer.from_file(LIBRARY)
    tokenizer.add_tokens([AddedToken("<|x|>", **({"normalized": False} | flags)), AddedToken("<|x|><|y|>", normalized=False)])
    path = str(tmp_path / "t.json")
    tokenizer.save(path)
    texts = [*TEXTS, "a <|x|> b", "a<|x|>b", "<|x|><|y|> <|x|>", f"  <|x|>  {END}  "]
    assert by_text(texts, path) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_shards_of_texts_with_added_tokens(spark):
    tokenizer = Tokenizer.from_file(LIBRARY)
    at, expected = 0, []
    for i, text in enumerate(TEXTS):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        expected.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert sorted(tuple(r) for r in token_binary.read_ids(token_binary.write_ids(df, LIBRARY)).collect()) == expected

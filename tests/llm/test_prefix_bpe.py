"""Prefix BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from bazaarlens.llm.prefix_bpe import EditableText, encode_documents, encoder, read_ranks

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def texts(seed: int, n: int):
    pick = random.Random(seed)
    some = "aeiouthnrs \n\t.,'0123éüñ漢🙂  \x1c\x85'sABC"
    for _ in range(n):
        yield "".join(pick.choice(some) for _ in range(pick.randrange(60)))
        yield "".join(pick.choice("the and ing tion er es un re ") for _ in range(pick.randrange(300)))
        yield pick.choice("ab -\n0") * pick.randrange(400)


def test_ids_are_the_library_s(library):
    bpe = encoder(PATH, PATTERN)
    for t in texts(1, 700):
        assert np.frombuffer(bpe.encode(t), "<u4").tolist() == library.encode_ordinary(t), repr(t)
        assert bpe.decode(bpe.encode(t)) == t.encode()


def test_every_prefix_has_its_last_token(library):
    bpe = encoder(PATH, PATTERN)
    for word in (b" internationalisation", b"aaaaaaaaaaaaaaaaaaaaaaaaa", "weiterführende".encode()):
        last = [-1]
        bpe.extend(word, last)
        for i in range(1, len(word) + 1):
            assert bpe.tokens(last, i) == library._core_bpe.encode_single_piece(word[:i])


def test_edits_and_appends(library):
    bpe, pick = encoder(PATH, PATTERN), random.Random(5)
    for text in texts(2, 60):
        edited = EditableText(bpe, text)
        for more in texts(pick.randrange(1 << 30), 2):
            a = pick.randrange(len(edited.text) + 1)
            b = min(len(edited.text), a + pick.randrange(5))
            edited.replace(a, b, more[: pick.randrange(20)])
            assert edited.ids() == library.encode_ordinary(edited.text), (edited.text, a, b)
            edited.append(more[:9])
            assert edited.ids() == library.encode_ordinary(edited.text)


def test_an_edit_keeps_far_tables():
    edited = EditableText(encoder(PATH, PATTERN), "one two three four five six seven eight nine ten")
    before = [m[2] for m in edited.matches]
    edited.replace(20, 21, "x")
    assert sum(any(m[2] is t for t in before) for m in edited.matches) >= 9


def check(rows, want, library):
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(
        (
            str(i), len(ids := library.encode_ordinary(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((t or "").encode()).hexdigest(),
        )
        for i, t in want
    )


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query(spark, library, folder):
    from bazaarlens.llm.queries import op5_prefix_bpe

    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("doc_id", "text").collect()
    check(op5_prefix_bpe(spark, f"/root/testdata/{folder}").collect(), docs, library)


def test_odd_rows(spark, library):
    want = [(1, None), (2, ""), (3, "x" * 50_000), (3, "same"), (3, "same"), (None, "a  　 b"), (9, "w " * 600_000)]
    docs = spark.createDataFrame([(*x, "n", "i") for x in want], "doc_id long, text string, n_tokens string, ids string")
    check(encode_documents(docs, PATH, PATTERN).collect(), want, library)
    assert encode_documents(docs.limit(0), PATH, PATTERN).count() == 0


def test_one_cut_of_the_bytes_for_each_place():
    class Counted(bytes):
        cuts = 0

        def __getitem__(self, at):
            Counted.cuts += 1
            return bytes.__getitem__(self, at)

    last = [-1]
    encoder(PATH, PATTERN).extend(Counted(b" internationalisation"), last)
    assert min(last[1:]) >= 0 and Counted.cuts <= len(last)

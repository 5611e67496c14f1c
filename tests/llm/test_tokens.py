"""Tokenizer alignment against a plain version that compares byte ranges."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from llm_util import docs_frame, messy
from tokenizers import Tokenizer

from veilwork.llm import tokens
from veilwork.llm.queries import op13_tokenizer_alignment

FOLDER = tokens.FOLDER


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/piece_bpe_32k.model")


def plain(models, texts):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups."""
    a, b = models
    symbols = tokens.byte_symbols()
    counts, per_text = Counter(), []
    for text in texts:
        if not text:
            per_text.append(None)
            continue
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        parts_a = [bytes(symbols[c] for c in a.id_to_token(i)) for i in ids_a]
        parts_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(parts_a) != b" " + text.encode() or b"".join(parts_b) != b" " + text.encode():
            per_text.append(None)
            continue
        links, groups, i, j, end_a, end_b = [], [], 0, 0, len(parts_a[0]), len(parts_b[0])
        group = [[ids_a[0]], [ids_b[0]]]
        while True:
            links.append((ids_a[i], ids_b[j]))
            low = min(end_a, end_b)
            if end_a == end_b:
                groups.append(group)
                group = [[], []]
            if end_a == low:
                i += 1
            if end_b == low:
                j += 1
            if i == len(ids_a) or j == len(ids_b):
                assert i == len(ids_a) and j == len(ids_b)
                break
            if end_a == low:
                more = end_a + len(parts_a[i])
                group[0].append(ids_a[i])
            if end_b == low:
                end_b += len(parts_b[j])
                group[1].append(ids_b[j])
            if end_a == low:
                end_a = more
        counts.update(links)
        per_text.append((len(ids_a), len(ids_b), links, ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)))
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    out = []
    for one in per_text:
        if one is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = one
        best = sum(counts[x] == highest[x[1]] for x in links)
        out.append((n_a, n_b, groups.count(";") + 1, len(links), best, sum(counts[x] for x in links), groups))
    return out


ODD = [
    "Plain words, and more words.", "Plain words, and more words.", " leading  and   many spaces ", "tabs\tand\nlines\r\n\n\nend", "▁marked ▁ text",
    "日本語のテキスト。漢字かな", "emoji 👩‍👩‍👧‍👦 and flags 🇩🇪", "<|endoftext|> <s> </s> <unk> <0x41>", "x" * 3000, "ÀÉîõü ﬁne", "\x00nul \x01 \x7f", "1234567890 3.14159e-10",
    "don't can't we'll I'M", " ", "\n", "a", "ｆｕｌｌ ｗｉｄｔｈ", "é combining", " nbsp em", "﻿bom", "العربية नमस्ते", "a" + "̀" * 50,
]


def test_alignment_matches_a_plain_version(spark, models):
    rows = [(i, t, "s") for i, t in enumerate(ODD)] + messy(30_000)
    wanted = sorted([(r[0] is None, r[0] or 0, *p) for r, p in zip(rows, plain(models, [r[1] for r in rows]), strict=True)])
    found = tokens.align_tokenizers(docs_frame(spark, rows))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted([(r[0] is None, r[0] or 0, *r[1:]) for r in map(tuple, found.collect())]) == wanted


def test_blocks_of_few_windows_give_the_same(spark, models, monkeypatch):
    rows = [(i, t, "s") for i, t in enumerate(ODD * 3)]
    wanted = sorted((r[0], *p) for r, p in zip(rows, plain(models, [r[1] for r in rows]), strict=True))
    df = docs_frame(spark, rows).repartition(3)
    build = tokens._blocks

    def small(*args):
        made, fields = build(*args)

        def run(batches):
            tokens.MEMO_WINDOWS = 5
            cut = (batch.slice(i, 2) for batch in batches for i in range(0, len(batch), 2))
            return made(cut)

        return run, fields

    monkeypatch.setattr(tokens, "_blocks", small)
    assert sorted(map(tuple, tokens.align_tokenizers(df).collect())) == wanted


def test_byte_file_and_fast_encoder_agree(models):
    """On every code point, with letters, digits, marks, spaces and itself around it."""
    a, _ = models
    fast = tokens.byte_bpe(f"{FOLDER}/byte_bpe_50k.json")
    texts = [f"a{c}b 1{c}2 .{c}. {c}{c}x  {c}'s {c}" for c in map(chr, [*range(0xD800), *range(0xE000, 0x30000, 7)])]
    wanted = a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
    assert all(x.tolist() == y.ids for x, y in zip(fast.encode(texts), wanted, strict=True))


def test_long_numbers_survive_packing():
    import numpy as np

    numbers = np.array([0, 1, 255, 256, 2**31, 2**32 - 1, 70_000])
    assert tokens.unpacked(tokens.packed(numbers), len(numbers)).tolist() == numbers.tolist()
    assert tokens.unpacked(tokens.packed(numbers[:0]), 0).tolist() == []
    assert tokens.ranges(np.array([3, 9, 0]), np.array([5, 9, 2])).tolist() == [3, 4, 0, 1]


def test_empty_and_unusable_texts(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    zeros = [(1, *[0] * 6, ""), (2, *[0] * 6, "")]
    assert sorted(map(tuple, tokens.align_tokenizers(df).collect())) == zeros
    assert sorted(map(tuple, tokens.align_tokenizers(df, digest=True).collect())) == zeros
    assert tokens.align_tokenizers(df.limit(0)).collect() == []


def test_query_over_the_table(spark, models):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    wanted = []
    for row, (*n, groups) in zip(rows, plain(models, [r["text"] for r in rows]), strict=True):
        wanted.append((row["doc_id"], *n, hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
    assert sorted(map(tuple, op13_tokenizer_alignment(spark, folder).collect())) == sorted(wanted)

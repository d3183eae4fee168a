"""The Merkle manifest against hashing level by level."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from serieslake.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, root int, at int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(parts))


def levels(nodes, fanout):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[k : k + fanout])) for k in range(0, len(nodes), fanout)]
        out.append(nodes)
    return out


def path(tree, place, fanout):
    steps = []
    for nodes in tree[:-1]:
        low = place - place % fanout
        run = nodes[low : low + fanout]
        steps.append(("".join(run[: place - low]), "".join(run[place - low + 1 :])))
        place //= fanout
    return steps


def brute(rows, fanout):
    lower = {k: k + 32 for k in range(65, 91)}
    by_lang = {}
    for doc_id, text, lang, source, n in rows:
        own = leaf(doc_id, source, lang, n, text)
        probe = own
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            probe = leaf(doc_id, source, lang, n, text and text.translate(lower))
        by_lang.setdefault(lang, []).append((doc_id is not None, doc_id or 0, own, probe, doc_id))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels([r[2] for r in sorted(by_lang[x])], fanout) for x in langs}
    top = levels([trees[x][-1][0] for x in langs], fanout)
    out = []
    for at, lang in enumerate(langs):
        for place, (_, _, own, probe, doc_id) in enumerate(sorted(by_lang[lang])):
            steps = path(trees[lang], place, fanout) + path(top, at, fanout)
            held = probe
            for left, right in steps:
                held = sha(left + held + right)
            proof = sha("".join(a + b for a, b in steps))
            root = top[-1][0]
            out.append((doc_id, own, trees[lang][-1][0], root, proof, held, held == root))
    return sorted(out, key=str)


def rows_of(sizes):
    rows, number = [], 0
    for lang, size in sizes.items():
        for k in range(size):
            rows.append((number, f"Text {number} É" if k % 3 else "lower only", lang or None, None if k % 2 else "s", k))
            number += 1
    return rows


def answers(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in manifest.document_manifest(table, **options).collect()), key=str)


@pytest.mark.parametrize(
    "fanout, inner, sizes",
    [
        (8, 3, {"en": 70, "de": 9, "": 3, "fr": 1}),
        (2, 1, {"en": 45, "de": 17, "": 2, "fr": 1, "es": 33, "xx": 8}),
        (3, 1, {"a": 82, "b": 81, "Z": 10, "ä": 28, "": 5}),
        (2, 2, {"one": 1}),
    ],
)
def test_manifest(spark, fanout, inner, sizes):
    """Trees of one and of many blocks, full and ragged; every round of the exchange counts."""
    rows = rows_of(sizes)
    assert answers(spark, rows, fanout=fanout, inner=inner) == brute(rows, fanout)


def test_manifest_odd_rows(spark):
    rows = rows_of({"en": 20}) + [
        (None, "No id", "en", "s", 1),
        (None, None, None, None, None),
        (3, "Same id", "en", "s", None),
        (3, "Same id", "en", "s", None),
        (4, "", "", "", 0),
        (5, "Long É " * 50_000, "en", "s", 1),
    ]
    assert answers(spark, rows, fanout=2, inner=1) == brute(rows, 2)


def test_manifest_empty(spark):
    assert answers(spark, []) == []

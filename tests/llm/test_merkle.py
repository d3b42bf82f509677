"""Leaves, roots, proofs and tampering of the Merkle manifest against plain Python."""

import hashlib
import zlib

from pyspark.sql import functions as F

from tidewell.llm import merkle, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """All levels of a tree, from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        lo = at // 8 * 8
        out.append(("".join(level[lo:at]), "".join(level[at + 1 : lo + 8])))
        at //= 8
    return out


def fold(leaf, proof):
    for left, right in proof:
        leaf = sha(left + leaf + right)
    return leaf


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text); the result sorted as text."""
    leaf = lambda r: sha("".join(map(field, r)))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    parts = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs}
    trees = {g: tree([leaf(r) for r in parts[g]]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs]) if langs else []
    out = []
    for n, g in enumerate(langs):
        for i, r in enumerate(parts[g]):
            proof = path(trees[g], i) + path(top, n)
            low = r[4] if r[4] is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            folded = fold(leaf((*r[:4], low)) if hit else leaf(r), proof)
            sibs = "".join(a + b for a, b in proof)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], sha(sibs), folded, folded == top[-1][0]))
    return sorted(map(str, out))


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def written(spark, rows, folder, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def result(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_whole_table(spark, sf, docs):
    want = brute([tuple(r) for r in docs.select(*merkle.FIELDS).collect()])
    got = result(queries.op11_merkle_manifest(spark, sf))
    assert got == want and sum("False" in r for r in got) > 0


def test_several_tiers_of_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "DIGITS", 1)
    rows = [(i * 7 % 701, "s", "en" if i % 3 else "de", i, f"Text {i}") for i in range(700)]
    rows += [(i, None, f"l{i}", 1, "X") for i in range(20)]
    assert result(queries.op11_merkle_manifest(spark, written(spark, rows, tmp_path))) == brute(rows)


def test_nulls_empty_and_long_texts_ties_and_repeated_rows(spark, tmp_path):
    rows = [(5, "s", "en", 3, "ABC")] * 9 + [(5, "t", "en", 3, "ABC"), (None, None, None, None, None)]
    rows += [(None, "s", "en", 0, ""), (None, None, None, 7, "Ünï Ä"), (6, "", "", 0, "Long TEXT " * 200_000)]
    assert result(queries.op11_merkle_manifest(spark, written(spark, rows, tmp_path))) == brute(rows)


def test_one_row_and_no_row(spark, tmp_path):
    one = [(1, "s", "en", 3, "abc")]
    folder = written(spark, one, tmp_path / "one")
    assert result(queries.op11_merkle_manifest(spark, folder)) == brute(one)
    assert queries.op11_merkle_manifest(spark, written(spark, [], tmp_path / "none")).count() == 0


def test_other_fields_and_clashing_columns(spark):
    rows = [(i, f"v{i}", i % 2, "x", "y") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, hash string, lang int, nodes string, _at string")
    got = merkle.manifest(df, fields=("doc_id", "hash"), carry={"path": F.col("nodes")})
    assert got.columns == ["id", "group", "leaf", "subroot", "root", "proof", "path"]
    found = got.withColumn("f", merkle.folded(F.col("leaf"), F.col("proof"))).collect()
    assert len(found) == 30 and {r["f"] for r in found} == {found[0]["root"]} and {r["path"] for r in found} == {"x"}
    assert {r["leaf"] for r in found} == {sha(field(i) + field(f"v{i}")) for i in range(30)}

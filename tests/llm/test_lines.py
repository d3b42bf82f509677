"""Line and word counts of one text, and lines of many documents, against plain Python."""

import random
import re
from collections import Counter

from tidewell.llm import lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, limit, share):
    """rows: (id, host, text), each once."""
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x).lower().strip(" ")
    seen = Counter()
    for _, host, text in rows:
        seen.update({(host, norm(x)) for x in (text or "").split("\n") if WORD.search(x)})
    out = {}
    for i, host, text in rows:
        words = WORD.findall(text or "")
        three = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {p for j in range(len(words) - 2) if three[tuple(words[j : j + 3])] > 1 for p in (j, j + 1, j + 2)}
        own = [x for x in (text or "").split("\n") if WORD.search(x)]
        common = sum(len(WORD.findall(x)) for x in own if seen[host, norm(x)] > limit)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        out[i] = (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(own) - len(set(own)),
            len(covered), common, failed, not failed and len(words) - common >= share * len(words),
        )
    return out


def result(df):
    names = (*lines.BASE, "n_common_words", "base_failed", "kept")
    return {r["doc_id"]: tuple(r[c] for c in names) for r in df.collect()}


def test_counts_and_frequent_lines(spark):
    rng = random.Random(2)
    pool = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.randrange(1, 12))) for _ in range(30)]
    texts = ["\n".join(rng.choice(pool) + rng.choice(["", " ", "\t#", "\r"]) for _ in range(rng.randrange(1, 25))) for _ in range(120)]
    texts += [None, "", " \n\t\n", "a b c a b c a b c", "é" * 10, "x " * 60, "A  b\nа B\na\tb " * 20]
    rows = [(i, rng.choice(["h", "h", "g", None]), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    assert result(lines.filter_lines(df, max_documents=6)) == brute(rows, 6, lines.MIN_SHARE)


def test_repeated_rows_null_ids_clashing_columns_and_empty(spark):
    text = "one two three four five " * 3 + "\n" + " ".join(f"w{i}" for i in range(80))
    rows = [(1, "s", text, 0)] * 12 + [(None, "s", text, 1), (2, None, None, 2)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, n_words int")
    got = lines.filter_lines(df, max_documents=3)
    assert sorted(map(str, result(got))) == ["1", "2", "None"]
    assert got.count() == 14 and got.columns.count("n_words") == 1
    # Twelve equal rows are one document, with the other null id there are two: not above 3.
    assert {r["kept"] for r in got.where("doc_id = 1").collect()} == {True}
    assert lines.filter_lines(df.limit(0)).count() == 0


def test_lines_above_the_limit_are_taken_out_of_the_text(spark):
    rows = [(i, "h", f"Own {i}\r\n\n MENU  Home \nx\tx\n\nown {i} b\nmenu home") for i in range(5)]
    rows += [(5, "g", "menu home\nmine"), (6, "h", "menu home"), (7, "h", None), (8, "h", ""), (6, "h", "menu home")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = lines.filter_lines(df, max_documents=4).collect()
    want = {i: f"Own {i}\r\n\n\nown {i} b" for i in range(5)}
    want |= {5: "menu home\nmine", 6: "", 7: None, 8: ""}
    assert len(got) == 10 and all(r["kept_text"] == want[r["doc_id"]] for r in got)


def test_columns_named_like_outputs_and_work_columns(spark):
    names = ("n_common_words", "kept", "kept_text", "_k1", "_k2", "_at", "_split", "base_failed")
    rows = [(i, "h", "menu home\n" + f"own {i} " * 60, *["x"] * len(names)) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, " + ", ".join(f"{n} string" for n in names))
    got = lines.filter_lines(df, max_documents=3)
    assert len(set(got.columns)) == len(got.columns)
    assert result(got) == brute([r[:3] for r in rows], 3, lines.MIN_SHARE)


def test_lines_are_cut_once_and_the_text_is_left_out_on_request(spark):
    rows = [(i, "h", "menu home\n" + " ".join(f"w{i}x{j}" for j in range(60 if i else 2))) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = lines.filter_lines(df, max_documents=4, keep_text=False)
    assert result(got) == brute(rows, 4, lines.MIN_SHARE)
    assert got.columns == [c for c in lines.filter_lines(df, max_documents=4).columns if c != "kept_text"]
    # The lines are read back where they were stored; neither the count nor the join cuts them again.
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()

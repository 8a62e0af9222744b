"""Conversation repair, line dedup and spelling variants against brute force."""
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from claimlake.llm import conversation, line_dedup, spelling
from tests.llm.conftest import edge_rows


def by_row(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# line dedup --------------------------------------------------------------------

SPACES = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute_lines(rows, min_chars, min_docs):
    holders = {}
    rank = lambda d: (d is not None, d if d is not None else 0)  # noqa: E731  a null id is the least
    for d, t in rows:
        for line in (t or "").split("\n"):
            k = lower(line.strip(SPACES))
            if len(k) >= min_chars:
                holders.setdefault(k, set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(h := holders.get(lower(x.strip(SPACES)), ())) < min_docs or max(h, key=rank) == d]
        out.append((d, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=repr)


def line_rows(seed, n=120):
    rng = random.Random(seed)
    stock = [rng.choice(["", "\t ", "É"]) + "".join(rng.choice("abcdeFGH éß日") for _ in range(rng.randint(3, 60))) + rng.choice(["", " ", "\x0b\r"])
             for _ in range(25)]
    rows = [(rng.choice([i, i, i, i // 2]), "\n".join(rng.choice(stock) if rng.random() < 0.6 else f"own line {i} {k} " * 3 for k in range(rng.randint(0, 9))))
            for i in range(n)]
    rows += [(500 + i, "a line that very many documents hold, in the middle\n" * rng.randint(1, 4) + f"tail {i}") for i in range(400)]
    return rows + [(None, rows[0][1]), (None, stock[0] + "\n" + stock[1]), (901, None), (902, ""), (903, "\n\n"), rows[3], rows[3],
                   (904, "x" * 200_000 + "\n" + stock[2]), (905, (stock[3] + "\n") * 20_000)]


@pytest.mark.parametrize("seed,chars,least,parts", [(1, 40, 5, 3), (2, 5, 2, 60), (3, 20, 3, 200)])
def test_lines_equal_brute_force(spark, seed, chars, least, parts):
    rows = line_rows(seed)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)  # small ranges: hashes are cut by the bounds
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert by_row(line_dedup.digests(df, min_chars=chars, min_docs=least)) == brute_lines(rows, chars, least)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lines_edge_table(edge, no_docs):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert by_row(line_dedup.digests(edge, min_docs=2)) == brute_lines(rows, 40, 2)
    assert line_dedup.digests(no_docs).count() == 0 and line_dedup.keep_bitmaps(no_docs).count() == 0


def test_line_bitmaps_of_string_ids(spark):
    line = "the same long line in all of the documents here"
    df = spark.createDataFrame([(f"d{i}", f"{line}\nrest {i}\n{line.upper()}") for i in range(6)], "name string, body string")
    maps = line_dedup.keep_bitmaps(df, "name", "body")
    got = {r.doc_id: list(line_dedup.unpack(r.n_lines, r.keep)) for r in maps.collect()}
    assert got == {f"d{i}": [False, True, False] for i in range(5)}
    cut = {r.doc_id: bytes(r.kept).decode() for r in line_dedup.apply(df, maps, "name", "body").collect()}
    assert cut["d0"] == "rest 0" and cut["d5"] == f"{line}\nrest 5\n{line.upper()}"


def test_line_of_all_documents_is_spread(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "concat('a line that all of the documents have in common\n', id, ' own words that no other document has, ', id) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = line_dedup.dropped_lines(df)
        assert out.count() == 19_999
        tasks = line_dedup.line_rows(df, "doc_id", "text", 40)
        order = ["h1", "h2", "doc", "row", "pos"]
        sizes = [r["count"] for r in tasks.repartitionByRange(*order).selectExpr("spark_partition_id() AS t").groupBy("t").count().collect()]
        assert max(sizes) < 2 * 40_000 / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# spelling ----------------------------------------------------------------------

def edits_to(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows, min_chars=5, min_count=3):
    counts = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            counts[w if h % 97 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}
    near = {w: [v for v in words if edits_to(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        top = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=repr)


def spelled_rows(seed, letters="abÄé", docs=60):
    rng = random.Random(seed)
    stock = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(150)]
    weight = [1 / (k + 1) for k in range(len(stock))]
    rows = [(i, " ".join(rng.choices(stock, weight, k=rng.randint(0, 120)))) for i in range(docs)]
    long = "ab" * 50_000
    return rows + [(None, rows[0][1]), (None, None), (100, ""), (101, "12 34 !?"), rows[1], rows[1], *[(200 + i, f"{long} {long}c x{long}") for i in range(4)],
                   *[(300 + i, "aaaaaa aaaaaaa bbbbb" + "q" * 39 + " bbbbb" + "q" * 40 + " " + "z" * 40 + " " + "z" * 41) for i in range(5)]]


@pytest.mark.parametrize("seed,letters,block", [(1, "abÄé", 20_000), (2, "ab", 3), (3, "abcdefghij", 20_000), (4, "aÿ", 20_000)])
def test_spelling_equals_brute_force(spark, seed, letters, block):
    rows = spelled_rows(seed, letters)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = by_row(spelling.variants(df, block=block).select("word", "form", "root", "n", "n_near", "form_n"))
    assert got == brute_words(rows)


def test_spelling_edge_table(edge, no_docs, spark):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert by_row(spelling.variants(edge).select("word", "form", "root", "n", "n_near", "form_n")) == brute_words(rows)
    assert spelling.variants(no_docs).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(no_docs, min_chars=3)


def test_pivots_are_disjoint_and_lightest():
    rng = random.Random(5)
    for _ in range(200):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(4, 12)))
        grams = sorted({word[i:i + 2] for i in range(len(word) - 1)}, key=lambda _: rng.random())
        rank = {g: k for k, g in enumerate(grams)}
        weight = sorted(rng.randint(1, 50) for _ in grams)
        prefix = spelling.prefix_of(word, rank)
        got = spelling.pivots_of(prefix, weight)
        best = min(weight[a[0]] + weight[b[0]] for a, b in itertools.combinations(prefix, 2) if abs(a[1] - b[1]) >= 2)
        assert len(got) == 2 and abs(got[0][1] - got[1][1]) >= 2 and sum(weight[g[0]] for g in got) == best


def test_few_candidates_meet(spark):
    """Look-ups that meet a stored word are far fewer than all pairs."""
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(6, 9))) for _ in range(3000)})
    df = spark.createDataFrame([(i, w, 5) for i, w in enumerate(words)], "id long, word string, n long")
    rows = spelling.entries(df, spelling.gram_order(df))
    met = rows.where("role = 1").alias("l").join(rows.where("role = 0").alias("s"), "key").count()
    assert met < len(words) ** 2 / 50


# conversations ------------------------------------------------------------------

def judged(rows):
    """(letter counts, rows as (initial, fault, role, text)) of one conversation in order."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(SPACES)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(SPACES)[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role[:1], fault, role, text))
    return out


def brute_repair(rows):
    """Cheapest, ASCII-least repair by search over all edits (at most two inserts in a row)."""
    best = {("", 0): (0, "", ())}  # (grammar state, inserts in a row) -> cost, audit, lines
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def push(into, state, value):
        if state not in into or value[:2] < into[state][:2]:
            into[state] = value

    def inserted(level):
        for k in (0, 1):
            for (state, n), (c, a, lines) in list(level.items()):
                if n == k:
                    for role in ("user", "assistant"):
                        if (state, role[0]) in step:
                            push(level, (step[state, role[0]], k + 1), (c + 5, a + "I", (*lines, role + ":")))
        return level

    for ini, fault, role, text in judged(rows):
        after = {}
        for (state, _), (c, a, lines) in inserted(best).items():
            push(after, (state, 0), (c + 2, a + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault else 0
            if (state, ini) in step:
                push(after, (step[state, ini], 0), (c + extra, a + "K", (*lines, f"{role}:{text}")))
            for given in ("user", "assistant"):
                if (state, given[0]) in step:
                    push(after, (step[state, given[0]], 0), (c + extra + 1, a + "R", (*lines, f"{given}:{text}")))
        best = after
    ends = [v for (state, _), v in inserted(best).items() if state in ("", "a")]
    return min(ends, key=lambda v: v[:2])


def brute_row(conv, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults = Counter(f for _, f, _, _ in judged(rows))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, lines = brute_repair(rows)
    return conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def talk_rows(seed, n=120):
    rng = random.Random(seed)
    texts = ["Yes.", "Yes.", "No!", "Why?", "and then", "", " \t", "Well. ", "Ω?\n", "x" * 3000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "s"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(0, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Line {turn}."))
    return rows + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hm."), (None, None, None, None), (7, None, None, "Text."), (8, 2, "user", None)]


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("seed", [1, 2])
def test_repairs_equal_brute_force(spark, seed):
    rows = talk_rows(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'clash' AS audit", "'clash' AS conv", "1 AS present")
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    want = sorted((brute_row(c, r) for c, r in convs.items()), key=repr)
    assert by_row(conversation.repair(df).select(COLUMNS)) == want


@pytest.mark.parametrize("seed", [3, 4])
def test_damaged_conversations_equal_brute_force(spark, seed):
    rows = talk_rows(seed, 200) + [(c, 0, "user", "One.") for c in range(1000, 1100)]
    convs = {}
    for c, turn, role, text in rows:
        out = convs.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        lot = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if lot == 0:
            continue
        role, text = "user" if lot == 4 else role, "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        out += [(turn, role, text)] * (2 if lot == 3 else 1)
    want = sorted((brute_row(c, r) for c, r in convs.items()), key=repr)
    assert not all(convs.values())
    df = conversation.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = by_row(conversation.repair(df, present_col="present").select(COLUMNS))
    assert got == want


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation.repair(conversation.damage(none), present_col="present").count() == 0


def test_long_conversation_and_string_ids(spark):
    n = 30_000
    df = spark.range(n).selectExpr("'all' AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('Turn ', id, '.') AS text")
    r = conversation.repair(df).first()
    assert (r.conv_id, r.cost, r.audit, r.gaps) == ("all", 0, "K" * n, 0)
    text = "\n".join(f"{'assistant' if i % 2 else 'user'}:Turn {i}." for i in range(n))
    assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_other_costs_use_inserts():
    costs = conversation.Costs(rerole=9, delete=9, insert=1)
    assert conversation.Automaton(costs).solve("uu") == (2, "KIKI")
    assert conversation.Automaton(costs).solve("a") == (1, "IK")
    assert conversation.Automaton(conversation.Costs()).solve("") == (0, "")


def test_a_shared_suffix_is_solved_once():
    automaton = conversation.Automaton(conversation.Costs())
    for s in sorted(("suauaua"[k:] for k in range(7)), key=lambda s: s[::-1]):
        automaton.solve(s)
    assert automaton.made == 7


def test_edge_texts_as_conversations(spark):
    rows = [(d, 0, "user", t) for d, t in edge_rows()]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn, role, " " if text is None else text))
    assert by_row(conversation.repair(df).select(COLUMNS)) == sorted((brute_row(c, r) for c, r in convs.items()), key=repr)

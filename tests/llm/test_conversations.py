"""Reply trees, source divergence and the prefix trie against plain Python, on small tables with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyrisk.llm import chat, divergence, trie

TALK = "conv_id long, turn long, role string, text string"
TREE = "thread long, id long, parent long, role string, text string, score double"


def rows_of(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


def talks() -> list[tuple]:
    """Shared beginnings, copies, ties, repeated rows, nulls, empty and long texts, control strings."""
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 60), 100, 101, 199, 205, 350, 1024, 1025, -3, -120]:
        if c % 7 == 3:
            rows += [(c, k, "user", "same") for k in range(3)]
            continue
        for k in range(rng.randint(1, 9)):
            rows.append((c, k, rng.choice(["user", "assistant", None, "a>b"]), rng.choice(["hi", "", None, "ünï 😀", "<turn x>", "a\\</turn>\n"])))
    rows += [(401, None, "user", "first"), (401, 1, "user", "b"), (401, 1, "assistant", "a"), (401, 5, "assistant", "z")]
    rows += [(402, 2, "user", "twice"), (402, 2, "user", "twice")]
    rows += [(403, k, "assistant", "x" * 5000 + "\\") for k in range(40)]
    return rows


# ---- reply trees


def brute_paths(rows, best):
    """The best paths of each thread; a message's row with the largest (parent, score) counts."""
    kept = {}
    for thread, key, parent, _, _, score in rows:
        if key is not None:
            mine = (parent is not None, parent or 0, score or 0.0)
            kept[thread, key] = max(kept.get((thread, key), mine), mine)
    body = {}
    for thread, key, _, role, text, _ in rows:
        if key is not None:
            body[thread, key] = max(body.get((thread, key), ("", "")), (role or "", text or ""))
    parents = {(t, p) for (t, _), (has, p, _) in kept.items() if has}
    paths = defaultdict(list)
    for thread, leaf in kept:
        if (thread, leaf) in parents:
            continue
        path, key = [], leaf
        while key is not None and (thread, key) in kept and key not in path:
            path.append(key)
            has, parent, _ = kept[thread, key]
            key = parent if has else None
        if key in path:
            continue
        path.reverse()
        paths[thread].append((-sum(kept[thread, k][2] for k in path) / len(path), leaf, path))
    out = {}
    for thread, found in paths.items():
        for rank, (score, leaf, path) in enumerate(sorted(found)[:best], 1):
            out[thread, rank] = (leaf, -score, [body[thread, k] for k in path])
    return out


def trees() -> list[tuple]:
    rng, rows = random.Random(5), []
    for thread in [1, 2, 3, None]:
        for k in range(40):
            parent = rng.randrange(k) if k and rng.random() > 0.1 else None
            rows.append((thread, k, parent, rng.choice(["user", "assistant", None]), f"m{k} <turn </turn>\n", rng.choice([None, 0.5, 1.0, 2.0])))
    rows += [(4, k, k - 1 if k else None, "assistant", str(k), 1.0) for k in range(70)]
    rows += [(5, 1, 99, "user", "orphan", 0.0), (5, 2, 1, "assistant", "reply", 0.0)]
    rows += [(6, 1, 2, "user", "circle", 0.0), (6, 2, 1, "user", "circle", 0.0), (6, 3, 2, "user", "behind", 9.0), (6, 4, None, "user", "fine", 0.0)]
    rows += [(7, 1, None, "user", "a", 1.0), (7, 1, None, "user", "b", 3.0), (7, None, 1, "user", "lost", 1.0), (7, 5, 5, "user", "self", 1.0)]
    return rows


@pytest.mark.parametrize("best", [1, 3, None])
def test_best_paths_equal_brute_force(spark, best):
    given = spark.createDataFrame([(*r, "x") for r in trees()], TREE + ", leaf string")
    want = brute_paths(trees(), best)
    got = {(r.thread, r["rank"]): r for r in chat.formatted(given, best).collect()}
    assert got.keys() == want.keys()
    for key, (leaf, score, turns) in want.items():
        row = got[key]
        assert (row.leaf, row.n_turns) == (leaf, len(turns))
        assert row.score == pytest.approx(score)
        assert list(chat.turns_of(row.formatted)) == turns
        assert [chat.plain(row.formatted[x.start : x.end]) for x in row.loss] == [t for role, t in turns if role == "assistant"]


@given(st.lists(st.tuples(st.text("\\<>/turn a\n😀"), st.text("\\<>/turn a\n😀")), max_size=5))
@settings(max_examples=200, deadline=None)
def test_turns_read_back(turns):
    mark = lambda pattern, text: re.sub(pattern, r"\\\g<0>", text)
    text = "".join(f"<turn {mark(chat.IN_ROLE, r)}>{mark(chat.IN_TEXT, t)}</turn>\n" for r, t in turns)
    assert list(chat.turns_of(text)) == turns


def test_torn_text_is_refused():
    with pytest.raises(ValueError, match="no turn"):
        list(chat.turns_of("<turn user>half"))


def test_chat_digests(spark):
    rows = [*talks(), (None, 1, "user", "nobody"), (-7, 0, "user", "\\### Assistant: </turn> ok")]
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = []
    for conv, found in turns.items():
        said = [(x[3], x[5]) for x in sorted(found)]
        learnt = "".join(t for r, t in said if r == "assistant")
        chars = sum(len(r) + len(t) + 15 + len(re.findall(chat.IN_ROLE, r)) + len(re.findall(chat.IN_TEXT, t)) for r, t in said)
        want.append((conv, len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(learnt), sha(learnt), chars))
    given = spark.createDataFrame([(*r, 1, "x") for r in rows], TALK + ", id long, thread string")
    assert rows_of(chat.digests(given)) == sorted(want, key=str)
    assert chat.digests(spark.createDataFrame([], TALK)).count() == 0


# ---- prefix trie


def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, said in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = tuple(convs.get(base, [])[:h] + said[h:])
    members = defaultdict(list)
    for c, said in whole.items():
        for d in range(len(said) + 1):
            members[said[:d]].append(c)
    children = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, convs_here in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs_here) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(whole[c]) == len(path))
        above = min(members[path[:-1]]) if path else None
        out.append((min(ids), len(path), above, len(ids), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def untied(rows):
    """Rows with a turn of their own: the order of ties is the operator's own."""
    return [r for r in rows if r[0] != 401]


def test_trie_equals_brute_force(spark, sf):
    rows = [*untied(talks()), (None, 0, "user", "nobody")]
    given = spark.createDataFrame([(*r, 1, 2) for r in rows], TALK + ", node long, shard long")
    assert rows_of(trie.digests(given)) == brute_trie(rows)
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    assert rows_of(trie.digests(table)) == brute_trie([tuple(r) for r in table.collect()])
    assert trie.digests(spark.createDataFrame([], TALK)).count() == 0


def test_trie_is_the_same_for_any_shard_width(spark):
    rows, convs = trie.rebuilt(trie.turn_rows(spark.createDataFrame(untied(talks()), TALK)))
    found = []
    for bits in (3, 6, 12):
        nodes, ends = trie.prefix_trie(rows, convs, bits)
        found.append(rows_of(nodes.join(trie.end_digests(ends, bits), "node", "left")))
    assert found[0] == found[1] == found[2]


def test_trie_puts_ties_in_one_order(spark):
    rows = [r for r in talks() if r[0] == 401]
    given = spark.createDataFrame([(k, *r[1:]) for k in (500, 600) for r in rows], TALK)
    turned = spark.createDataFrame([(k, *r[1:]) for k in (500, 600) for r in reversed(rows)], TALK)
    nodes, _ = trie.prefix_trie(*trie.rebuilt(trie.turn_rows(given)))
    again, _ = trie.prefix_trie(*trie.rebuilt(trie.turn_rows(turned)))
    assert rows_of(nodes) == rows_of(again)


# ---- source divergence


def brute_audit(rows, least=3, top=200):
    word = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = word.findall((text or "").translate(lower))
        groups[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        mine = {s: c for (x, s), c in groups.items() if x == lang}
        whole = sum(mine.values(), Counter())

        def p(count):
            size = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 1) // size for t in kept}

        base, own = p(whole), {s: p(c) for s, c in mine.items()}
        for s in mine:
            pairs = [(sum((own[s][t] - own[x][t]) ** 2 // own[x][t] for t in kept), x) for x in mine if x != s]
            best = [((own[s][t] - base[t]) ** 2 // base[t], t) for t in kept if mine[s][t] and own[s][t] > base[t]]
            for part, found, most in (("pair", pairs, None), ("term", best, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(found[:most], 1)]
    return sorted(out, key=str)


def sourced() -> list[tuple]:
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "abcdefghij" for b in ["", "é", "zz", "Q", "ß漢"]]
    rows = []
    for lang, sources in (("en", "abcde"), ("de", "xy"), ("fr", "z"), (None, "pq")):
        for k in range(60):
            n = rng.choice([0, 1, 5, 40])
            rows.append((" ".join(rng.choices(words, k=n, weights=range(1, 51))) + ".3_", lang, rng.choice(sources)))
    rows += [("only once here", "es", "a"), ("other", "es", "b"), (None, "es", None), ("", None, None)]
    rows += [("x " * 3000 + "Ünique", "en", "a"), ("common " * 7, "en", "e")] * 3
    return rows


@pytest.mark.parametrize("top", [200, 4])
def test_audit_equals_brute_force(spark, top):
    rows = sourced()
    given = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "text string, lang string, source string, term long, n long, word long")
    assert rows_of(divergence.audit(given, top=top)) == brute_audit(rows, top=top)


def test_audit_of_nothing(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit(spark.createDataFrame([], schema)).count() == 0
    given = spark.createDataFrame([(None, "en", "a"), ("few words", "en", "b"), ("", "en", "c")], schema)
    assert rows_of(divergence.audit(given)) == brute_audit([tuple(r) for r in given.collect()])


def test_audit_in_small_steps(spark, monkeypatch):
    """The same rows however early counts and pair sums are handed on, and long texts are cut."""
    rows = sourced()
    given = spark.createDataFrame(rows, "text string, lang string, source string")
    pieces = divergence._pieces
    monkeypatch.setattr(divergence, "_pieces", lambda text: pieces(text, 16))
    terms = divergence.term_counts(given.na.fill(""), 3, limit=7).cache()
    groups = divergence.group_totals(given.na.fill(""), terms).cache()
    levels = divergence.level_bitmaps(terms, groups)
    found = divergence.pair_values(levels, groups, cells=5, limit=3)
    want = [(a, b, item, value) for a, b, part, item, value, _ in brute_audit(rows) if part == "pair"]
    assert rows_of(found) == sorted(want, key=str)

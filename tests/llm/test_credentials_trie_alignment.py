"""Operators 11 to 13 against brute force, with awkward inputs."""

import bisect
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from daybook.llm import alignment, credentials, prefix_trie
from daybook.llm.common import read
from daybook.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, block int, pairs string, doc int"


def frame(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, "en", None, 1, 0.5, "x", 1, "p", 2) for i, t in zip(ids, texts, strict=True)], SCHEMA)


# -- operator 11 --------------------------------------------------------------------

FORMS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)),
    ("access", re.compile("AKIA[A-Z0-9]+")),
    ("hex", re.compile("[0-9a-f]+")),
]


def base_brute(text):
    out = []
    for n, (kind, p) in enumerate(FORMS):
        for m in p.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= (6, 20, 24)[n]:
                out.append((m.start(), n, m.end()))
    return [(FORMS[n][0], a, b) for a, n, b in sorted(out)]


def digest_of(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


AKIA = "AKIA" + "Q7" * 8
TOKEN = "kJ8dPq2xVn5RtY7wZb3c"
SECRET_TEXTS = [
    None, "", "plain text without anything", "é😀 token = 'abcdef' secret:abc PASSWORD=\"s3cr3t.value\"", "api_key=abcdefg=token=zzzzzz apikey : xy",
    "paſsword = abcdefgh toKen=abcdefgh", f"x{AKIA}y AKIA AKIAB", "0" * 23 + " " + "0" * 24 + "g" + "deadbeef" * 4, f"user = bob, {TOKEN}",
    f"user = bob\n \n{TOKEN}", "user = bob" + " x" * 300 + f" {TOKEN}", f"{TOKEN} alone", "see https://example.org/a for more",
    "login: bob https://db.example.org:5432 password=hunter22", "login: bob https://db.example.org", f"{AKIA} {TOKEN}", "token" + " " * 20000 + "x",
    "f" * 100000, "user = a" * 3000 + " secret=abcdef", "token=" * 5000,
]


def reported_brute(text, reach):
    """All pairs of parts, one by one."""
    base = credentials.base_spans(text)
    parts = base + credentials.weak_spans(text, base)
    cuts = [m.end() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    scope = [bisect.bisect_right(cuts, a) for _, a, _ in parts]

    def beside(i, kinds):
        return any(
            kind in kinds and scope[j] == scope[i] and b > parts[i][1] - reach and a < parts[i][2] + reach for j, (kind, a, b) in enumerate(parts)
        )

    out = []
    for i, (kind, a, b) in enumerate(parts):
        identifier, secret = beside(i, ("access", "user")), beside(i, ("assign", "hex", "weak"))
        needed = {"user": secret, "weak": identifier, "endpoint": identifier and secret}
        if needed.get(kind, True):
            out.append((a, credentials.KINDS.index(kind), b, kind))
    return [(k, a, b) for a, _, b, k in sorted(out)]


def test_secret_scan_equals_brute_force(spark):
    got = {r.doc_id: r for r in credentials.scan_credentials(frame(spark, SECRET_TEXTS)).collect()}
    short = {r.doc_id: r for r in credentials.span_digests(credentials.scan_credentials(frame(spark, SECRET_TEXTS))).collect()}
    for i, text in enumerate(SECRET_TEXTS):
        base, every = base_brute(text), reported_brute(text or "", credentials.REACH)
        assert [(s.kind, s.start, s.end) for s in got[i].spans] == every, text[:60] if text else text
        assert [s.value for s in got[i].spans] == [text[a:b] for _, a, b in every]
        assert short[i].base_sha256 == digest_of(base)
        assert [short[i].n_assign, short[i].n_access, short[i].n_hex] == [sum(k == f for k, *_ in base) for f, _ in FORMS]
        assert short[i].spans == ",".join(f"{k}:{a}:{b}" for k, a, b in every)


def test_weak_parts_need_complementary_ones(spark):
    kinds = [[s.kind for s in r.spans] for r in credentials.scan_credentials(frame(spark, SECRET_TEXTS)).orderBy("doc_id").collect()]
    assert kinds[8] == ["user", "weak"]
    assert kinds[9] == kinds[10] == kinds[11] == kinds[12] == kinds[14] == []  # other scope, too far, alone, no identifier, no secret
    assert kinds[13] == ["user", "endpoint", "assign"]
    assert kinds[15] == ["access", "weak"]


def test_secret_scan_of_registered_table(spark):
    rows = LLM_QUERIES["op11_credentials"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert r.base_sha256 == digest_of(base_brute(texts[r.doc_id]))


def test_interval_partners_equal_all_pairs():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        low, start = rnd.integers(0, 60, 8), rnd.integers(0, 60, rnd.integers(0, 9))
        high, end = low + rnd.integers(1, 20, 8), start + rnd.integers(1, 20, len(start))
        got = credentials.partners(low, high, start, end)
        for i in range(8):
            hits = [j for j in range(len(start)) if start[j] < high[i] and end[j] > low[i]]
            assert (got[i] in hits) if hits else got[i] == -1


# -- operator 12 --------------------------------------------------------------------


def trie_brute(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            h = hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()
            by[c].append(((t is not None, t or 0, int(h[:15], 16), int(h[15:30], 16)), (r, x)))
    own = {c: [v for _, v in sorted(turns, key=lambda z: z[0])] for c, turns in by.items()}
    seq = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        seq[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h]) + tuple(own[c][h:])
    members, children, leaves, saved, out = defaultdict(list), defaultdict(set), {}, {}, []
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for n in members:
        if n:
            children[n[:-1]].add(n)
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in children[n]) or 1
        saved[n] = sum(saved[k] for k in children[n]) + (len(members[n]) - 1) * (len(n[-1][1]) if n else 0)
        ends = ",".join(str(c) for c in sorted(members[n]) if len(seq[c]) == len(n))
        parent = min(members[n[:-1]]) if n else None
        out.append((min(members[n]), len(n), parent, len(members[n]), len(children[n]), leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def talk(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, path string, rep int")


def trie(df, capacity=prefix_trie.CAPACITY):
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(df, capacity).collect()), key=lambda r: r[:2])


@pytest.fixture(scope="module")
def talks():
    rnd, rows = random.Random(1), []
    for c in range(150):
        n = rnd.choice([1, 2, 5, 6, 30])
        rows += [(c, rnd.choice([t, t, t // 2, None]), rnd.choice(["u", "a", None]), rnd.choice(["x" * (t % 7)] * 9 + [None])) for t in range(n)]
    for c in range(500, 512):  # copies
        rows += [(c, t, "u", str(t)) for t in range(40)]
    for c in range(600, 620):  # each continues the one before
        rows += [(c, t, "u", str(t)) for t in range(c - 599)]
    rows += [(c, t, "u", f"{t}é") for c in (777, 778, 888) for t in range(300)]  # shared beyond any look
    rows += [(888, 300, "u", "end"), (-5, 1, "u", "z"), (None, 1, "u", "z"), (901, 1, None, None), (901, 1, None, None)]
    return rows


@pytest.mark.parametrize("capacity", [100_000, 200, 1])
def test_trie_equals_brute_force(spark, talks, capacity):
    assert trie(talk(spark, talks), capacity) == trie_brute(talks)


def test_trie_of_hot_turn_and_hot_conversation(spark):
    rows = [(c, t, "u", "same" if t == 0 else f"{c % 7} {t}") for c in range(0, 9000, 100) for t in range(3)]
    rows += [(50_000, t // 3, "u", str(t % 2)) for t in range(400)]
    assert trie(talk(spark, rows), 50) == trie_brute(rows)


def test_trie_of_registered_table_and_empty_tables(spark):
    rows = [tuple(r) for r in read(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in LLM_QUERIES["op12_prefix_trie"](spark, SF).collect()), key=lambda r: r[:2])
    assert got == trie_brute(rows)
    assert trie(talk(spark, [])) == []
    assert trie(talk(spark, [(None, 1, "u", "x")])) == []
    assert trie(talk(spark, [(7, None, None, None)])) == trie_brute([(7, None, None, None)])


def test_member_lists_are_digested_in_runs(spark, monkeypatch):
    rows = [(c * 100, 0, "u", "same") for c in range(9000)]
    assert trie(talk(spark, rows)) == trie_brute(rows)


# -- operator 13 --------------------------------------------------------------------


def alignment_brute(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(alignment.A_PATH)
    a_side.encode_special_tokens = True
    b_side = SentencePieceProcessor(model_file=alignment.B_PATH)
    bytes_a, bytes_b = alignment.ByteLevel(alignment.A_PATH).table(), alignment.PieceModel(alignment.B_PATH).table()
    figures, links, held = [], [], Counter()
    for text in texts:
        want = (" " + text).encode() if text else b""
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        if b"".join(bytes_a[i] for i in a) != want or b"".join(bytes_b[i] for i in b) != want:
            a = b = []
        ends_a, ends_b = np.cumsum([len(bytes_a[i]) for i in a]).tolist(), np.cumsum([len(bytes_b[i]) for i in b]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        groups = [([], []) for _ in cuts]
        for side, (ids, ends) in enumerate(((a, ends_a), (b, ends_b))):
            for i, e in zip(ids, ends, strict=True):
                groups[bisect.bisect_left(cuts, e)][side].append(i)
        pairs = Counter()
        for x, y in groups:
            cx, cy = Counter(x), Counter(y)
            for i, n in cx.items():
                for j, m in cy.items():
                    pairs[i, j] += n * m
        held.update(pairs.keys())
        links.append(pairs)
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        figures.append((len(a), len(b), len(groups), sum(pairs.values()), hashlib.sha256(line.encode()).hexdigest() if a else ""))
    best = {}
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    return [
        (*f[:4], sum(n for p, n in pairs.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in pairs.items()), f[4])
        for f, pairs in zip(figures, links, strict=True)
    ]


ALIGNED = [
    None, "", " ", "a", "The quick brown fox.", "The quick brown fox.", " two  spaces\n\n\ttabs\r\n", "▁ mark", "<|endoftext|> <s> </s> <unk> <0x41>",
    "漢字かな交じり文 " * 50, "é😀́\x00\x7f" * 30, "acgt" * 3000, "a" * 20000, " " * 3000 + "x", "x" + "\n" * 2500, "".join(map(chr, range(0x4E00, 0x5200))),
    "naïve café 1234567890 don't we'll",
]


def test_alignment_equals_brute_force(spark):
    ids = [i if i != 3 else None for i in range(len(ALIGNED))]
    got = alignment.alignment_scores(frame(spark, [*ALIGNED, ALIGNED[4]], [*ids, 4]).repartition(3)).collect()
    want = alignment_brute([*ALIGNED, ALIGNED[4]])
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *w)) for i, w in zip([*ids, 4], want, strict=True))


def test_alignment_of_registered_table_and_empty_table(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in LLM_QUERIES["op13_alignment"](spark, SF).collect()}
    assert got == {d.doc_id: w for d, w in zip(docs, alignment_brute([d.text for d in docs]), strict=True)}
    assert alignment.alignment_scores(frame(spark, [])).collect() == []


def test_groups_break_where_a_start_reaches_the_running_maximum():
    a, b = alignment.coalesce(np.array([0, 2, 5]), np.array([2, 5, 9]), np.array([0, 3, 5, 7]), np.array([3, 5, 7, 9]))
    assert a.tolist() == [0, 0, 1] and b.tolist() == [0, 0, 1, 1]


@pytest.mark.parametrize("listed, pairs", [(4096, 1 << 23), (3, 1 << 23), (3, 7), (0, 1)])
def test_linked_pairs_in_ranges(monkeypatch, listed, pairs):
    monkeypatch.setattr(alignment, "LISTED", listed)
    monkeypatch.setattr(alignment, "PAIRS", pairs)
    rnd = np.random.default_rng(0)
    for _ in range(20):
        group_a, group_b = (np.sort(np.r_[np.arange(6), rnd.integers(0, 6, 20)]) for _ in range(2))
        a, b, row = rnd.integers(0, 9, 26), rnd.integers(0, 9, 26), np.array([0, 0, 1, 1, 1, 3])
        want = Counter((int(row[g]), int(x) * 10 + int(y)) for g, x in zip(group_a, a, strict=True) for h, y in zip(group_b, b, strict=True) if g == h)
        got = Counter()
        for rows, key, times in alignment.linked_pairs(a, b, group_a, group_b, row, 10):
            assert len(set(zip(rows, key, strict=True))) == len(key)
            for r, k, n in zip(rows.tolist(), key.tolist(), times.tolist(), strict=True):
                assert (r, k) not in got
                got[r, k] = n
        assert got == want

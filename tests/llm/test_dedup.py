import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from gridloom.llm import exact_dedup, ngram_join
from gridloom.llm.exact_dedup import RadixTrie, drop_copies, mark_copies


def brute_copies(rows):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc or 0))
    out = Counter()
    for body, members in groups.items():
        members.sort()
        keep = None if members[0][1] else members[0][2]
        for i, (_, missing, doc) in enumerate(members):
            out[(None if missing else doc, keep, len(members), i == 0, hashlib.sha256(body.encode()).hexdigest())] += 1
    return out


def test_copies_equal_brute_force(odd, odd_rows, monkeypatch):
    marked, names = mark_copies(odd.select("doc_id", "text"))
    assert names == ["text_sha256", "keep_id", "group_size", "kept"]
    found = Counter(map(tuple, marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()))
    assert found == brute_copies(odd_rows)


def test_copies_in_many_tasks(spark, odd_rows):
    """Copies that differ in white space meet wherever their tasks put them."""
    rows = [*odd_rows, *[(5000 + i, odd_rows[i % 20][1].replace(" ", " " * (1 + i % 3)) + "\n" * (i % 4), "en", "s0", 1) for i in range(120)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(40)
    marked, _ = mark_copies(docs.select("doc_id", "text"))
    found = Counter(map(tuple, marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()))
    assert found == brute_copies(rows)


def test_copies_beside_clashing_columns(clashing, odd_rows, none):
    marked, names = mark_copies(clashing)
    assert names == ["_text_sha256", "_keep_id", "_group_size", "_kept"]
    assert marked.count() == len(odd_rows)
    kept = drop_copies(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == sum(n for row, n in brute_copies(odd_rows).items() if row[3])
    assert drop_copies(none).count() == 0


@pytest.mark.parametrize("budget", [1 << 30, 6_000])
def test_trie_sums_by_string_with_and_without_spilling(budget):
    rng = random.Random(1)
    keys = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() * rng.choice([1, 1, 9]) for _ in range(1500)]
    trie = RadixTrie(lambda a, b: (a[0], a[1] + b[1]), budget)
    for k in keys:
        trie.insert(k, (k, 1))
    assert bool(trie.spilled) == (budget < 1 << 30)
    found = list(trie.values())
    assert len(found) == len(set(keys))
    assert dict(found) == Counter(keys)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k, percent):
    sets = [shingles(text, k) for _, text, *_ in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return Counter((doc, len(sets[i]), least[find(i)]) for i, (doc, *_) in enumerate(rows))


def family(seed, families=12, size=14, length=120, changes=14):
    """Texts that drift from one another step by step, so links form chains."""
    rng = random.Random(seed)
    bank = [f"w{i}" for i in range(400)]
    rows = []
    for f in range(families):
        text = [rng.choice(bank) for _ in range(length)]
        for _ in range(size):
            for _ in range(rng.randint(0, changes)):
                text[rng.randrange(length)] = rng.choice(bank)
            rows.append((len(rows), " ".join(text), None, None, None))
            text = list(text)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (1, 80), (3, 60)])
def test_components_equal_brute_force(spark, k, percent):
    rows = family(k, changes=6)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = Counter(map(tuple, ngram_join.components_of(docs, k=k, percent=percent).collect()))
    assert found == brute_components(rows, k, percent)
    assert len({c for _, _, c in found}) < len(rows)


def test_components_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 5)
    rows = family(9, families=4, size=30, changes=5)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = Counter(map(tuple, ngram_join.components_of(docs, k=3, percent=80).collect()))
    assert found == brute_components(rows, 3, 80)


def test_components_when_shingles_and_blocks_are_split(spark, monkeypatch):
    """Near copies of texts of several lengths: sketches of several widths, split shingles, many blocks."""
    monkeypatch.setattr(ngram_join, "SPLIT", 4)
    monkeypatch.setattr(ngram_join, "BLOCK", 6)
    rng = random.Random(5)
    bank = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(3):
        base = [rng.choice(bank) for _ in range(rng.choice([130, 260, 520]))]
        for _ in range(40):
            text = list(base)
            for _ in range(rng.randint(0, 5)):
                text[rng.randrange(len(text))] = rng.choice(bank)
            if rng.random() < 0.3:
                text = text[: rng.randint(int(0.93 * len(text)), len(text))]
            rows.append((len(rows), " ".join(text), None, None, None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = Counter(map(tuple, ngram_join.components_of(docs, k=3, percent=90).collect()))
    assert found == brute_components(rows, 3, 90)


def test_components_of_odd_rows(odd, odd_rows, none, clashing):
    rows = [r for r in odd_rows if r[0] is not None]
    found = Counter(map(tuple, ngram_join.components_of(odd.where("doc_id is not null"), k=3, percent=90).collect()))
    assert found == brute_components(rows, 3, 90)
    every = Counter(map(tuple, ngram_join.components_of(odd, k=3, percent=90).collect()))
    nameless = every - found
    assert found - every == Counter() and all(doc is None and component is None and n > 0 for doc, n, component in nameless)
    assert sum(nameless.values()) == len(odd_rows) - len(rows)
    assert ngram_join.components_of(none).count() == 0
    with pytest.raises(TypeError, match="doc_id"):
        ngram_join.components_of(odd.withColumn("doc_id", odd["doc_id"].cast("string")))
    with pytest.raises(ValueError, match="percent"):
        ngram_join.Families(50, 10)
    kept = ngram_join.keep_one(clashing, k=3, percent=90)
    assert kept.columns == clashing.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 220 in ids and 221 not in ids and 201 not in ids and None in ids and 100 in ids and 101 in ids


@pytest.mark.parametrize("percent", [51, 60, 80, 90, 97])
def test_linked_sets_share_a_signature(percent):
    import numpy as np

    rng = np.random.default_rng(percent)
    families = ngram_join.Families(percent, 3000)
    sets = []
    for n in [1, 2, 3, 5, 9, 10, 11, 19, 20, 21, 50, 101, 400, 1500] * 6:
        one = rng.integers(0, 1 << 63, n).astype(np.uint64)
        while True:  # as far from it as a link allows, by chance
            gone, new = int(rng.integers(0, n + 1)), int(rng.integers(0, n + 1))
            both, union = n - gone, n + new
            if gone + new and 100 * both >= percent * union:
                break
            if rng.random() < 0.02:
                gone, new = 0, max(1, int(n * (100 - percent) / percent))
                break
        two = np.concatenate((one[gone:], rng.integers(0, 1 << 63, new).astype(np.uint64)))
        sets.append((one, two, 100 * (n - gone) >= percent * (n + new)))
    flat = [np.sort(x) for a, b, _ in sets for x in (a, b)]
    at = np.concatenate(([0], np.cumsum([len(x) for x in flat])))
    token, of = families.signatures(np.concatenate(flat), at)
    by = {i: set(token[of == i].tolist()) for i in range(len(flat))}
    assert all(by[2 * i] & by[2 * i + 1] for i, (_, _, linked) in enumerate(sets) if linked)
    strangers = sum(bool(by[2 * i] & by[2 * j]) for i in range(len(sets)) for j in range(i))
    assert strangers == 0


def test_link_block_joins_up_every_component():
    import numpy as np

    rng = random.Random(2)
    sets = []
    for _ in range(8):
        base = rng.sample(range(60), 20)
        for _ in range(6):
            if rng.random() < 0.8:
                base[rng.randrange(20)] = rng.randrange(60)
            sets.append(np.array(sorted(set(base))))
    links, leader = ngram_join.link_block(sets, 60, 80)

    def linked(a, b):
        both = len(set(a.tolist()) & set(b.tolist()))
        return 100 * both >= 80 * (len(a) + len(b) - both)

    assert all(linked(sets[a], sets[b]) for a, b in links)
    assert all(i == j or linked(sets[i], sets[j]) for i, j in enumerate(leader))
    one, two = exact_components(len(sets), links), exact_components(len(sets), [(i, j) for i in range(len(sets)) for j in range(i) if linked(sets[i], sets[j])])
    assert one == two


def exact_components(n, links):
    up = ngram_join.Union(n)
    for a, b in links:
        up.join(a, b)
    return [up.find(i) for i in range(n)]


def test_links_of_sets_whose_leaders_share_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    blocks = {0: [], 1: []}  # ids by their block of two
    for r in spark.range(40).selectExpr("id", "pmod(xxhash64(id), 2L) as block").collect():
        blocks[r.block].append(r.id)
    (la, a, _), (lb, b, pivot) = blocks[0][:3], blocks[1][:3]
    sets = {la: range(60), a: range(100), lb: [*range(60, 95), *range(100, 125)], b: range(25, 125), pivot: range(1000, 1100)}
    rows = [(i, " ".join(f"w{n}" for n in v), 0, int(i == pivot)) for i, v in sets.items()]
    members = spark.createDataFrame(rows, "id long, text string, comp long, degree long")
    links = {frozenset((r.src, r.dst)) for r in ngram_join._links(members, 1, 60).collect()}
    assert links == {frozenset((la, a)), frozenset((lb, b)), frozenset((a, b))}

"""Line de-duplication, the n-gram join and components against brute force."""

import random
import re
import string

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tenderloom.llm import graph, line_dedup, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_words string, component_id string"


def prose(rng, n):
    return ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 6))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA)


# --- line de-duplication -------------------------------------------------------------------------
@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=60), st.integers(1, 8))
def test_least_positions_are_the_last_least_of_each_window(values, width):
    low = np.array(values, np.uint64) << np.uint64(40)
    valid = np.ones(max(0, len(values) - width + 1), bool)
    want = {max(range(i, i + width), key=lambda j: (-values[j], j)) for i in range(len(values) - width + 1)}
    assert set(line_dedup.least_positions(low, valid, width).tolist()) == want


def passages(seed):
    rng = random.Random(seed)
    shared = [prose(rng, n) for n in (51, 60, 140)]
    rows = []
    for i in range(24):
        words = prose(rng, rng.randint(0, 90))
        for p in shared if i % 3 == 0 else ():
            at = rng.randint(0, len(words))
            words[at:at] = p
        rows.append((i, rng.choice([" ", "\n"]).join(words) if i % 2 else " ".join(words)))
    rows += [(30, rows[3][1]), (31, rows[3][1]), (3, rows[3][1]), (None, rows[6][1]), (32, None), (33, ""), (34, " \n\t"),
             (35, "once " * 49), (36, " ".join(prose(rng, 40) + shared[0][:49] + prose(rng, 5)))]
    return rows


def repeated_by_hand(rows, k=line_dedup.MIN_WORDS):
    """Words inside a run of k words that stands earlier: a smaller id, or further up in the text."""
    seen, out = set(), {}
    for i, t in sorted({(i, t) for i, t in rows}, key=lambda r: (r[0] is None, r[0] or 0, str(r[1]))):
        words = WORD.findall(t or "")
        mark = np.zeros(len(words), bool)
        for p in range(len(words) - k + 1):
            run = tuple(words[p:p + k])
            if run in seen:
                mark[p:p + k] = True
            seen.add(run)
        out[(i, t)] = mark
    return out


@pytest.mark.parametrize("seed", [1, 5])
def test_repeated_passages_are_those_of_brute_force(spark, seed):
    rows = passages(seed)
    want = repeated_by_hand(rows)
    got = line_dedup.repeated_runs(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    wanted = sorted((str(i), len(want[(i, t)]), int(want[(i, t)].sum())) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_repeated"]) for r in got) == wanted
    kept = line_dedup.remove_repeats(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "n_words", "component_id"]
    left = {}
    for r in kept.collect():
        left.setdefault(r["doc_id"], []).append(r["text"])
    assert 30 not in left and 31 not in left                    # copies: nothing is left of them
    assert left[32] == [None] and left[33] == [""] and left[34] == [" \n\t"] and len(left[35][0].split()) == 49
    for i, t in rows:
        if want[(i, t)].any() and i in left:
            words = np.array(WORD.findall(t))
            assert WORD.findall(left[i][0]) == words[~want[(i, t)]].tolist()
    assert line_dedup.repeated_runs(frame(spark, rows).limit(0)).count() == 0


def test_a_copy_is_found_behind_partial_ones(spark):
    rng = random.Random(11)
    shared = [prose(rng, n) for n in (80, 90, 120)]
    alone = lambda n: prose(rng, n)
    join = " ".join
    rows = [(i, join(alone(20) + shared[0][5 * i:5 * i + 40] + alone(20))) for i in range(9)]       # too short to count
    rows += [(20, join(alone(9) + shared[0] + alone(9))), (21, join(alone(30) + shared[0] + alone(3)))]
    rows += [(30, join(alone(9) + shared[1][:60] + alone(9))), (31, join(alone(9) + shared[1] + alone(9))),
             (32, join(alone(5) + shared[1] + alone(9)))]                                           # stops short of the end
    rows += [(40, join(alone(9) + shared[2][35:85] + alone(9))), (41, join(shared[2])), (42, join(shared[2]))]
    want = repeated_by_hand(rows)
    assert [int(want[r].sum()) for r in rows[9:]] == [0, 80, 0, 60, 90, 0, 50, 120]
    got = {r["doc_id"]: r for r in line_dedup.repeated_runs(frame(spark, rows)).collect()}
    assert [got[i]["n_repeated"] for i, _ in rows] == [int(want[r].sum()) for r in rows]
    left = {r["doc_id"]: r["text"].split() for r in line_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert left == {i: np.array(t.split())[~want[(i, t)]].tolist() for i, t in rows if not want[(i, t)].all()}
    with pytest.raises(ValueError):
        line_dedup.repeated_runs(frame(spark, rows), min_words=49)


# --- the join ------------------------------------------------------------------------------------
def near_copies(seed):
    rng = random.Random(seed)
    base = prose(rng, 120)
    rows = [(0, " ".join(base))]
    for i in range(1, 40):                                      # one large group around an original
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = "".join(rng.choices(string.ascii_lowercase, k=5))
        rows.append((i, " ".join(words)))
    chain = prose(rng, 60)
    for i in range(40, 52):                                     # neighbours are similar, the ends are not
        rows.append((i, "\t".join(chain)))
        chain = chain[2:] + prose(rng, 2)
    line = prose(rng, 12)
    for i in range(52, 70):                                     # a common line, and nothing else in common
        rows.append((i, " ".join(line) + "\n" + " ".join(prose(rng, rng.randint(3, 40)))))
    rows += [(70, "one"), (71, "ONE"), (72, "one two"), (73, "one two three"), (74, "One two three"), (75, ""), (76, None),
             (77, " \n"), (78, ""), (79, rows[41][1]), (79, rows[41][1]), (80, rows[41][1].upper()), (None, rows[52][1])]
    return rows


def components_by_hand(rows, k=4, percent=85):
    sets = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                group[find(i)] = find(j)
    members = {}
    for i, (doc, _) in enumerate(rows):
        members.setdefault(find(i), []).append(doc)
    least = {g: min((m for m in ms if m is not None), default=None) for g, ms in members.items()}
    return sorted(((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("long_list, chunk_count, meetings", [(64, 4, 5), (3, 2, 5), (2, 10 ** 9, 0)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, long_list, chunk_count, meetings):
    """Also where nearly every list is long, and where no shingle is known to be frequent."""
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    monkeypatch.setattr(ngram_join, "CHUNK_COUNT", chunk_count)
    monkeypatch.setattr(ngram_join, "MEETINGS", meetings)
    rows = near_copies(long_list)
    got = ngram_join.similar_components(frame(spark, rows))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=repr) == components_by_hand(rows)


def test_join_of_nothing(spark):
    empty = frame(spark, near_copies(1)).limit(0)
    assert ngram_join.similar_components(empty).count() == 0
    one = ngram_join.similar_components(frame(spark, [(5, None), (6, "a b c d e")])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in one) == [(5, 5), (6, 6)]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 3), (7, None)]
    edges += [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(25)]
    got = {r["node"]: r["component"] for r in graph.components(
        spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = {}
    for a, b in [e for e in edges if None not in e and e[0] != e[1]]:
        want.setdefault(a, a), want.setdefault(b, b)
    for _ in want:
        for a, b in [e for e in edges if None not in e and e[0] != e[1]]:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_short_lists_are_sorted_by_one_number_and_merged_as_arrays(spark):
    """Against counting by hand: equal sizes, equal classes met often, lists that are long."""
    rng = random.Random(4)
    rows = [(cls, 10 + cls % 3, sorted(rng.sample(range(-40, 40), 9)) + ([99] if cls < 70 else []), [1] * (cls % 2)) for cls in rng.sample(range(1000), 120)]
    rows += [(2000 + i, 11, [99], []) for i in range(ngram_join.LONG_LIST + 1)]
    firsts = spark.createDataFrame(rows, "cls long, n long, short array<int>, long array<int>").repartition(3)
    lists = ngram_join._short_lists(firsts, 80)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Sort \[(.*?)\], false", plan) and all("," not in keys for keys in re.findall(r"Sort \[(.*?)\], false", plan))
    of_token = {}
    for cls, n, short, _ in rows:
        for t in short:
            of_token.setdefault(t, []).append((n, cls))
    want, pairs = [], {}
    for t, members in of_token.items():
        for i, (n, cls) in enumerate(sorted(members)):
            if len(members) > ngram_join.LONG_LIST:
                want.append((cls, t, None))
            elif len(members) > 1:
                others = sorted(c for m, c in sorted(members)[:i] if 100 * m >= 80 * n)
                want.append((cls, None, others))
                for y in others:
                    pairs[cls, y] = pairs.get((cls, y), 0) + 1
    key = lambda r: (r[0], r[1] is None, r[1] or 0, r[2] or [])
    assert sorted(((r.cls, r.token, r.others) for r in lists.collect()), key=key) == sorted(want, key=key)

    sizes = {cls: (n, len(long)) for cls, n, _, long in rows}
    in_long = {cls: sum(1 for c, t, _ in want if c == cls and t is not None) for cls in sizes}
    met = {}
    for (x, y), times in pairs.items():
        n, n_long = sizes[x][0], sizes[x][1] + in_long[x]
        if times >= max(1, ngram_join._overlap(n, ngram_join._needed(n, 80), 80) - ngram_join._slack(n, 80) - n_long):
            met.setdefault(x, []).append((times, -y))
    expected = set()
    for x, found in met.items():
        for times, y in found:
            m, n = sizes[-y][0], sizes[x][0]
            if times + sizes[x][1] + in_long[x] >= ngram_join._overlap(n, m, 80) - max(ngram_join._slack(n, 80), ngram_join._slack(m, 80)):
                expected.add((x, -y, (times, y) == max(found)))
    assert expected and {tuple(r) for r in ngram_join._merged(lists, 80).collect()} == expected

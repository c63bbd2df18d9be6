"""Mixing, decontamination, quality and licenses on odd rows, against plain versions, and without Python in their plans."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from data import frame, odd_rows, prose

from propensa.llm import catalog, decontamination, divergence, licenses, mixing


def python_free(df) -> bool:
    return not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, odd_rows(), clashes=True)


def test_mixing_odd_rows(spark, docs):
    got = mixing.taken(mixing.assign(mixing.sized(docs)))
    assert python_free(got)
    got = got.collect()
    sizes = Counter()
    for r in odd_rows():
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:  # stop what is over twice its size and share the rest again
        level = (1.5 * sum(sizes.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        open_ -= over
    assert len(got) == len(odd_rows())
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.size * 2 >= r.taken and r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in names)


def test_curriculum(spark):
    rows = [(i, prose(i, 50), "en", "abc"[i % 3], 1) for i in range(600)]
    assigned = mixing.assign(mixing.sized(frame(spark, rows)))
    first = [(r.position, r.doc_id, r.source) for r in mixing.curriculum(assigned).collect()]
    again = [(r.position, r.doc_id, r.source) for r in mixing.curriculum(mixing.assign(mixing.sized(frame(spark, rows[::-1])))).collect()]
    assert first == again == sorted(first, key=lambda x: x[:2])  # range-sorted, whatever the input's order
    assert all(0 <= p <= 1 for p, _, _ in first)
    copies = Counter(i for _, i, _ in first)
    assert all(n <= 2 for n in copies.values())
    # b rises and c falls: b's share of the last third is larger than of the first, c's smaller.
    early, late = Counter(s for p, _, s in first if p < 1 / 3), Counter(s for p, _, s in first if p > 2 / 3)
    assert late["b"] > 1.2 * early["b"] and early["c"] > 1.2 * late["c"]
    middle = [p for p, _, s in first if s == "b"]
    assert len(middle) == pytest.approx(sum(r.taken / r.size for r in mixing.taken(assigned).where("source = 'b'").collect()))


def test_trained_follows_the_copies(spark, docs):
    assigned = mixing.assign(mixing.sized(docs))
    got = mixing.trained(assigned)
    assert python_free(got)
    got = got.collect()
    assert len(got) == len(odd_rows())
    shares = {(r._source, r.before, r.size): r.taken for r in mixing.taken(assigned).collect()}
    places, words = defaultdict(list), 0
    for c in sorted(mixing.curriculum(assigned).collect(), key=lambda c: (c.position, c.doc_id is not None, c.doc_id or 0, c._source, c.before)):
        places[c._source, c.before].append((c.position, words))
        words += c.size
    for r in got:
        own = places[r._source, r.before] if r.size else []
        assert r.taken == shares[r._source, r.before, r.size] == r.size * len(own)
        first = own[0] if own else (None, None)
        assert (r.first_position, r.first_word, r.last_position) == (*first, own[-1][0] if own else None)


def test_mixing_empty(docs):
    assigned = mixing.assign(mixing.sized(docs.limit(0)))
    assert mixing.taken(assigned).count() == 0 and mixing.curriculum(assigned).count() == 0 and mixing.trained(assigned).count() == 0


ITEM = prose(700, 33)
ITEMS = [(0, ITEM), (1, "short one"), (2, None), (3, "  ,. "), (4, ITEM), (5, "a b c d e"), (6, prose(701, 20) + " " + prose(701, 20))]


def plain_leaks(rows, items):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    found = {}
    for item, text in items:
        own = words(text)
        if not own:
            continue
        k = min(5, len(own))
        grams = lambda w: [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]  # noqa: E731, B023
        bag = grams(own)
        for doc, body, *_ in rows:
            all_ = grams(words(body))
            held = min(len(bag), len(all_))
            for start in range(max(0, len(all_) - held) + 1 if all_ else 0):
                window = all_[start:start + held]
                both = sum((Counter(window) & Counter(bag)).values())
                similarity = both / (len(window) + len(bag) - both)
                if similarity >= 0.8 and similarity > found.get((doc, item), (0, 0))[0]:
                    found[doc, item] = (similarity, start)
    return found


def leak_rows():
    words = ITEM.split()
    rows = [(1, prose(1, 60) + "\n" + ITEM + "\n" + prose(2, 60)), (2, ITEM.upper().replace(" ", ", ")), (3, " ".join(words[:30])),
            (4, " ".join(words[:20])), (5, prose(3, 40) + " " + " ".join([*words[:32], "altered"])), (6, "some short one here"), (7, None),
            (8, ""), (9, prose(4, 100)), (10, (ITEM + "\n") * 3), (10, (ITEM + "\n") * 3), (10, "other text of that id"), (None, "x " + ITEM),
            (11, " ".join(words[16:] + words[:16])), (12, " ".join(w for w in words if w != words[15])), (13, "a b c d e f"),
            (14, prose(701, 20) + " " + prose(701, 20) + " end"), (15, " ".join(words[2:] + words[:2]))]
    return [(*r, "en", "a", 1) for r in rows]


def test_leaks_equal_all_windows(spark):
    docs = frame(spark, leak_rows(), clashes=True)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontamination.leaks(docs, items)
    assert python_free(found)
    got = {(r.doc_id, r.item_id): r.similarity for r in found.collect()}
    want = {k: s for k, (s, _) in plain_leaks(leak_rows(), ITEMS).items()}
    assert got == pytest.approx(want)
    clean = {r.doc_id for r in decontamination.without_leaks(docs, items).collect()}
    assert clean == {r[0] for r in leak_rows()} - {d for d, _ in want}


def test_leaks_of_odd_and_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()} == set(plain_leaks(odd_rows(), ITEMS))
    assert decontamination.leaks(docs.limit(0), items).count() == 0
    assert decontamination.leaks(docs, items.limit(0)).count() == 0
    assert decontamination.without_leaks(docs, items.limit(0)).count() == len(odd_rows())


def test_blocks_guarantee_the_radius(spark):
    import random

    from pyspark.sql import functions as F

    rng, pairs = random.Random(3), []
    for distance in (0, 1, 12, 24):
        for _ in range(20):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), distance):
                b ^= 1 << bit
            pairs.append((a - (a >> 63 << 64), b - (b >> 63 << 64)))
    both = spark.createDataFrame(pairs, "a long, b long").select(
        F.arrays_overlap(decontamination._blocks(F.col("a"), 24), decontamination._blocks(F.col("b"), 24)).alias("met"))
    assert all(r.met for r in both.collect())


def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i:i + 3])].append(i)
    twice = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), sum(map((text or "").count, "#*$%&|<>")), len(lines) - len(set(lines)), len(twice), n < 50 or 100 * len(twice) > 50 * n)


def test_quality_base_rules(spark):
    rows = odd_rows() + [(900 + i, t, "en", "a", 1) for i, t in enumerate(
        ["a b c a b c", "x x x x", "l1 a\nl1 a\n\n\nl2\nl1 a", "# * a|b <c> & 5%", ("go on now " * 40), "é È ß 漢 字 " * 20, prose(5, 80) + "\n" + prose(5, 80)])]
    found = divergence.judge(frame(spark, rows, clashes=True))
    assert python_free(found)
    got = Counter(tuple(r)[:7] for r in found.collect())
    assert got == Counter((r[0], *plain_base(r[1])) for r in rows)


def test_quality_verdict(spark):
    clean = [(i, prose(i, 300), "en", "a", 1) for i in range(120)]
    table = [(1000 + i, " | ".join(prose(i, 300).split()), "en", "a", 1) for i in range(3)]
    signs = [(2000 + i, " ".join(w + "$%&" for w in prose(i, 300).split()), "en", "a", 1) for i in range(3)]
    few = [(3000, " ".join(w + "$%&" for w in prose(1, 300).split()), "xx", "a", 1)]  # too little text in that language to judge
    kept = {r.doc_id: r.kept for r in divergence.judge(frame(spark, clean + table + signs + few)).collect()}
    assert all(kept[r[0]] for r in clean + few) and not any(kept[r[0]] for r in table + signs)


def test_quality_empty(docs):
    assert divergence.judge(docs.limit(0)).count() == 0


def plain_license(text):
    matches = []
    kinds = [(n, t) for n, ts in licenses.TEMPLATES.items() for t in ts]
    for unit in dict.fromkeys((text or "").split("\n") + re.split(r"\n(?:[ \t\r\f\x0B]*\n)+", text or "")):
        words = licenses.normal_words(unit)
        bag = Counter(zip(words, words[1:], strict=False))
        best = None
        for i, (name, own) in enumerate(kinds):
            own = licenses.normal_words(own)
            other = Counter(zip(own, own[1:], strict=False))
            dice = 2 * sum((bag & other).values()) / (bag.total() + other.total())
            if dice >= 0.85 and (best is None or dice > best[0]):
                best = (dice, -i, name)
        if best:
            matches.append(best)
    return (max(matches)[2], max(matches)[0], len(matches)) if matches else (None, 0.0, 0)


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT"][2]
    cut = mit.split()
    texts = ["Released under the MIT License.", prose(1, 30) + "\nLicensed under CC BY-NC 4.0.\n" + prose(2, 30), mit, mit.upper(),
             "\n".join(" ".join(cut[i:i + 9]) for i in range(0, len(cut), 9)), "x\n\n" + "\n".join(" ".join(cut[i:i + 9]) for i in range(0, 60, 9)) + "\n\ny",
             " ".join(cut[:50]), " ".join(cut[:20]), "This work is licensed under the GNU General Public License, version 2.", "the license of", None, "",
             "Licensed under the Apache License, Version 2.0.\nLicensed under the Apache License, Version 2.0.", "released under the mit mit license",
             " ".join(cut[::-1]), "This   work is LICENSED under\tthe GNU general public license version 3"]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)] + odd_rows()
    found = licenses.scan(frame(spark, rows, clashes=True))
    assert python_free(found)
    got = [(r.doc_id, r.matches[0].license if r.matches else None, r.matches[0].dice if r.matches else 0.0, len(r.matches)) for r in found.collect()]
    want = [(r[0], *plain_license(r[1])) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(g[1] is not None for g in got) >= 9
    assert licenses.scan(frame(spark, rows).limit(0)).count() == 0


def plain_passages(text):
    """Per template the best window of its length, over all windows."""
    words, found = licenses.normal_words(text or ""), {}
    grams = list(zip(words, words[1:], strict=False))
    for i, own in enumerate(t for ts in licenses.TEMPLATES.values() for t in ts):
        own = licenses.normal_words(own)
        other = Counter(zip(own, own[1:], strict=False))
        held = min(other.total(), len(grams))
        known = [0]
        for g in grams:
            known.append(known[-1] + (g in other))
        for at in range(len(grams) - held + 1 if grams else 0):
            if known[at + held] - known[at] == 0:
                continue
            dice = 2 * (Counter(grams[at:at + held]) & other).total() / (held + other.total())
            if dice >= 0.85 and dice > found.get(-i, (0, ""))[0]:
                found[-i] = (dice, " ".join(words[at:at + held + 1]))
    return sorted(found.items())


def test_notices_inside_other_text(spark):
    gpl, mit, bsd = (licenses.TEMPLATES[n] for n in ("GPL-3.0", "MIT", "BSD"))
    header = "\n".join("# " + " ".join(gpl[1].split()[i:i + 9]) for i in range(0, 60, 9))
    whole = "\n\n".join(["MIT License", "Copyright (c) 2020 A. Person", *mit[2:]])
    bare = ["#\n" + header + "\n#\nimport os", whole, "\n".join(" * " + line for line in whole.split("\n")),
            prose(1, 30) + " This project is licensed under the MIT License. " + prose(2, 30),
            "Licensed under the MIT License. See LICENSE for details.", "// Licensed under the Apache License, Version 2.0 (see LICENSE)",
            prose(3, 9) + " " + " ".join(bsd[1:]) + " " + prose(4, 9), (mit[2] + " ") * 30, " ".join(mit[2].split()[3:]), mit[2].replace("free of charge", "at no cost")]
    clean = ["The license of the driver was suspended under the new law.", "MIT is a school; GNU is a project; the public license fee was raised.",
             "He was licensed under the state board in version 2.0 of the rules.", "Software is released to the public without any warranties, and the license is long.",
             "Permission is hereby granted to nobody.", prose(5, 3000)]
    rows = [(1000 + i, t, "en", "a", 1) for i, t in enumerate([*bare, *clean])] + odd_rows()
    found = licenses.best(licenses.scan(frame(spark, rows, clashes=True)))
    assert python_free(found)
    got = found.collect()
    assert sorted(((r.doc_id, sorted((m.order, (m.dice, m.unit)) for m in r.passages)) for r in got), key=str) == sorted(
        ((r[0], plain_passages(r[1])) for r in rows), key=str)
    names = {r.doc_id: r.best and r.best.license for r in got}
    assert [names[1000 + i] for i in range(len(bare))] == ["GPL-3.0", "MIT", "MIT", "MIT", "MIT", "Apache-2.0", "BSD", "MIT", "MIT", "MIT"]
    assert all(names[1000 + len(bare) + i] is None for i in range(len(clean)))


def test_every_template_matches_itself(spark):
    texts = [(n, t) for n, ts in licenses.TEMPLATES.items() for t in ts]
    got = licenses.scan(frame(spark, [(i, t, "en", "a", 1) for i, (_, t) in enumerate(texts)])).collect()
    assert all(r.matches[0].dice == 1.0 and r.matches[0].license == texts[r.doc_id][0] for r in got)


@pytest.mark.parametrize("name", ["op5_mix_sources", "op6_decontaminate", "op8_quality_divergence", "op10_license_scan"])
def test_queries_run_no_python(spark, sf_dir, name):
    assert python_free(catalog.queries()[name](spark, sf_dir))

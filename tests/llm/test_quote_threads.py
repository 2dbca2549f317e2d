import random
import re
from collections import defaultdict

from siftline.llm import queries
from siftline.llm import quote_threads as Q

SCHEMA = "conv_id long, turn long, role string, text string, position string"


def test_quotes_are_told_apart():
    text = "Alice wrote:\n> Good morning to all of you\n>> the very first words\n> and a second line\n\nMy own answer here.\n > indented quote line\nEnd"
    body, own, quotes = Q.said(text)
    assert body == "My own answer here.\nEnd"
    assert [(q["level"], q["whole"]) for q in quotes] == [(1, True), (2, True), (1, True), (1, True)]
    assert Q._hash("my own answer here. end") in own and Q._hash("my own answer here.") in own
    assert Q.said(None) == ("", [], []) and Q.said("a > b")[0] == "a > b"


def brute(rows):
    parsed = [(c, t, *Q.said(x)) for c, t, x in rows]
    says = defaultdict(list)
    for c, t, _, own, _ in parsed:
        if c is not None and t is not None:
            for h in own:
                says[h].append((c, t))
    links, merged = {}, defaultdict(dict)
    for c, t, _, _, quotes in parsed:
        if c is not None and t is not None:
            for q in quotes:
                merged[c, t][tuple(sorted(q.items()))] = q
    for (c, t), units in merged.items():
        found, hits = [], set()
        for q in units.values():
            mine = [x for x in says[q["hash"]] if x[0] == c]
            to = min(mine) if mine and min(mine)[1] < t else None
            if to is None:
                to = min((x for x in says[q["hash"]] if x[0] != c), default=None)
            found.append((q, to))
            if to and q["whole"]:
                hits.add(q["passage"])
        found = [(q, to) for q, to in found if q["whole"] or q["passage"] not in hits]
        sums = defaultdict(int)
        for q, to in found:
            if to:
                sums[q["level"], to] += q["chars"]
        reply = max(((n, to[1]) for (level, to), n in sums.items() if level == 1 and to[0] == c), default=None)
        most = max(((n, *to) for (_, to), n in sums.items()), default=None)
        n_linked = len({q["passage"] for q, to in found if to})
        links[c, t] = (len({q["passage"] for q, _ in found}), n_linked, reply[1] if reply else None, most[1] if most else None, most[2] if most else None)
    out = []
    for c, t, body, _, _ in parsed:
        n, linked, reply, qc, qt = links.get((c, t), (0, 0, None, None, None))
        root, depth = t, 0
        while (c, root) in links and links[c, root][2] is not None:
            root, depth = links[c, root][2], depth + 1
        out.append([c, t, root, reply, depth, n, linked, qc, qt, body])
    return out


def check(spark, rows):
    df = spark.createDataFrame([(c, t, "user", x, "clash") for c, t, x in rows], SCHEMA).repartition(4)
    got = Q.threads(df).collect()
    names = ["conv_id", "turn", "thread_turn", "reply_to_turn", "reply_depth", "n_quotes", "n_linked", "quoted_conv_id", "quoted_turn", "text"]
    key = lambda r: tuple((x is None, x) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(([r[n] for n in names] for r in got), key=key) == sorted(brute(rows), key=key)
    by = defaultdict(list)
    for r in got:
        by[r.conv_id].append(r)
        assert ">" not in (r.text[:1],)
    for rs in by.values():
        rs.sort(key=lambda r: r.position)
        assert [r.position for r in rs] == list(range(len(rs)))
        order = [((r.thread_turn is not None, r.thread_turn or 0), (r.turn is not None, r.turn or 0), r.text_hash) for r in rs]
        assert order == sorted(order)
    return got


def test_against_brute_force(spark):
    rng = random.Random(4)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = []
    for conv in range(40):
        told = []
        for turn in range(rng.choice([1, 4, 9, 30])):
            own = [" ".join(rng.choices(words, k=rng.randrange(1, 9))) for _ in range(rng.randrange(1, 4))]
            quote = []
            for _ in range(rng.choice([0, 0, 1, 2])):
                if told or rows:
                    source = rng.choice(told) if told and rng.random() < 0.8 else rng.choice(rows)[2] if rows else told[0]
                    lines = source.split("\n")
                    a = rng.randrange(len(lines))
                    quote += [("> " if rng.random() < 0.5 else ">") + x.upper() for x in lines[a : a + rng.choice([1, 2, 9])]]
                    quote += ["", *(["Someone wrote:"] if rng.random() < 0.3 else [])]
            told.append("\n".join([*quote, *own]))
            rows.append((conv, turn, told[-1]))
    got = check(spark, rows)
    assert sum(r.n_linked for r in got) > 50 and max(r.reply_depth for r in got) > 1


def test_edge_cases(spark):
    long = "a rather long original sentence"
    rows = [(1, 0, None), (1, 1, ""), (1, 2, long), (1, 2, long), (1, 3, f"> {long}\nyes"), (1, 4, f">> {long}\n> yes\nno, not at all"), (None, 0, f"> {long}"), (2, None, f"> {long}"), (3, 5, f"> {long}"), (3, 6, "> never said by anyone")]
    rows += [(9, i, f"> this very common quoted sentence\nanswer number {i} of many" if i else "this very common quoted sentence") for i in range(200)]
    check(spark, rows)
    df = spark.createDataFrame([(1, 0, "user", "x", "y")], SCHEMA)
    assert Q.threads(df.limit(0)).count() == 0


def test_quotes_said_later_here_are_found_in_other_conversations(spark):
    x = "what several conversations say alike"
    rows = [(1, 5, f"> {x}\nfirst answer"), (1, 7, x), (2, 0, x), (3, 0, x), (4, 1, f"> {x}\nsecond answer"), (5, 1, "> said only later on, and here"), (5, 2, "said only later on, and here")]
    got = {(r.conv_id, r.turn): (r.n_linked, r.reply_to_turn, r.quoted_conv_id, r.quoted_turn) for r in Q.threads(spark.createDataFrame([(c, t, "user", x, "") for c, t, x in rows], SCHEMA)).collect()}
    assert got[1, 5] == (1, None, 2, 0)
    assert got[4, 1] == (1, None, 1, 7)
    assert got[5, 1] == (0, None, None, None)


def test_short_quotes(spark):
    rows = [(1, 0, "Yes, I agree"), (1, 1, "Why?"), (1, 2, "> why?\nsince it is so"), (1, 3, "> 好的，明天见\nfine"), (2, 0, "> Why?\n> why?\nno idea"), (3, 0, "好的，明天见")]
    df = spark.createDataFrame([(c, t, "user", x, "") for c, t, x in rows], SCHEMA)
    for least, other in ((1, (1, 1, 1)), (12, (0, None, None))):
        got = {(r.conv_id, r.turn): (r.n_quotes, r.reply_to_turn, r.thread_turn, r.n_linked, r.quoted_conv_id, r.quoted_turn) for r in Q.threads(df, elsewhere_chars=least).collect()}
        assert got[1, 2] == (1, 1, 1, 1, 1, 1)
        assert got[2, 0] == (1, None, 0, *other)
        assert got[1, 3] == (1, None, 3, *((1, 3, 0) if least == 1 else (0, None, None)))


def plain(text):
    """(what a message says: whole, passages, lines; its quoted passages as (depth, lines)), told without the operator's parser."""
    told, quoted = [[]], []
    for line in (text or "").split("\n"):
        marks = re.match(r"\s*(>\s*)*", line)[0] if line.lstrip().startswith(">") else ""
        clean = " ".join(line[len(marks) :].split()).casefold()
        depth = marks.count(">")
        if not depth:
            told.append([]) if not clean else told[-1].append(clean)
        if not clean:
            quoted.append((0, []))
        elif depth and quoted and quoted[-1][0] == depth:
            quoted[-1][1].append(clean)
        else:
            quoted.append((depth, [clean] if depth else []))
    runs = [" ".join(r) for r in told if r]
    return {" ".join(runs), *runs, *(x for r in told for x in r)} - {""}, [q for q in quoted if q[0]]


def test_replies_query(spark):
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.text) for r in queries.with_quoted_replies(source).select("conv_id", "turn", "text").collect()]
    assert len(rows) == source.count()
    told = {(c, t): plain(x) for c, t, x in rows}
    says = defaultdict(list)
    for at, (own, _) in told.items():
        for x in own:
            says[x].append(at)
    got = {(r.conv_id, r.turn): r for r in queries.quoted_replies(spark, sf).collect()}
    assert len(got) == len(rows) == len(told)
    for (c, t), (_, quoted) in told.items():
        def found(x, c=c, t=t):
            here = min((y[1] for y in says[x] if y[0] == c), default=t)
            return (c, here) if here < t else min((y for y in says[x] if y[0] != c), default=None)
        linked, chars = 0, defaultdict(int)
        for depth, lines in quoted:
            whole = " ".join(lines)
            hits = [(whole, found(whole))] if found(whole) else [(x, found(x)) for x in lines if len(lines) > 1]
            linked += any(to for _, to in hits)
            for x, to in {(x, to) for x, to in hits if to}:
                chars[depth, to] += len(x)
        reply = max(((n, to[1]) for (depth, to), n in chars.items() if depth == 1 and to[0] == c), default=(0, None))[1]
        r = got[c, t]
        assert (r.n_quotes, r.n_linked) == (len(quoted), linked), (c, t)
        assert r.reply_to_turn == reply, (c, t)
    assert sum(r.n_linked for r in got.values()) > len(got) // 2 and max(r.reply_depth for r in got.values()) > 1

"""Randomised check of the price-point rules against a plain-Python model."""

import json
import random

from oddsline.operators import decode as B

LO, HI = 1577836800000, 2208988800000


def model_point(item):
    """Expected (t, p) of one history item, or None when it is dropped."""
    if not isinstance(item, dict) or "t" not in item or "p" not in item:
        return None
    t_raw, p_raw = item["t"], item["p"]
    if isinstance(t_raw, (bool, int, float)):
        t = int(t_raw * 1000) if t_raw < 10_000_000_000 else int(t_raw)
    elif isinstance(t_raw, str):
        try:
            t = int(t_raw)
        except ValueError:
            return None
        if t != 0 and not (LO <= t <= HI):
            return None
    else:
        return None
    try:
        p = float(p_raw)
    except (TypeError, ValueError):
        return None
    return t, p


def rand_t(rnd):
    return rnd.choice([
        lambda: rnd.randrange(0, 2_000_000_000),                  # seconds
        lambda: rnd.randrange(LO - 10**9, HI + 10**9),            # ms, some out of the text range
        lambda: rnd.randrange(0, 2_000_000_000) + 0.25,           # float seconds
        lambda: str(rnd.randrange(LO, HI)),                       # text ms
        lambda: str(rnd.randrange(0, 2_000_000_000)),             # text seconds (rejected)
        lambda: "0",
        lambda: " 1600000000000 ",
        lambda: "12.5",
        lambda: "soon",
        lambda: None,
        lambda: True,
        lambda: [1],
    ])()


def rand_p(rnd):
    return rnd.choice([
        lambda: rnd.randrange(0, 10_000) / 100,
        lambda: rnd.randrange(0, 100),
        lambda: str(rnd.randrange(0, 10_000) / 100),
        lambda: "1e-3",
        lambda: " 0.5 ",
        lambda: "x",
        lambda: None,
        lambda: False,
        lambda: {"v": 1},
    ])()


def rand_item(rnd):
    kind = rnd.random()
    if kind < 0.05:
        return rnd.choice([5, "junk", None, [1, 2]])
    item = {}
    if rnd.random() > 0.05:
        item["t"] = rand_t(rnd)
    if rnd.random() > 0.05:
        item["p"] = rand_p(rnd)
    return item


def test_price_points_match_model(spark):
    rnd = random.Random(2024)
    rows, want = [], []
    for page in range(300):
        items = [rand_item(rnd) for _ in range(rnd.randrange(0, 12))]
        rows.append(("tok", page, json.dumps({"history": items})))
        for pos, it in enumerate(items):
            m = model_point(it)
            if m is not None:
                want.append((page, pos, m[0], m[1]))
    land = spark.createDataFrame(rows, "token_id string, chunk_start bigint, payload string")
    good, rej = B.decode_price_history(land)
    got = sorted((r.chunk_start, r.pos, r.t, r.p) for r in good.collect())
    assert rej.count() == 0
    assert got == sorted(want)


# ------------------------------------------------------------------ markets

TRUE_TEXT = {"1", "on", "t", "true", "y", "yes"}
FALSE_TEXT = {"0", "off", "f", "false", "n", "no"}
STR_KEYS = {"question": "question", "description": "description", "marketSlug": "market_slug",
            "conditionId": "condition_id", "createdAt": "created_at", "endDate": "end_date",
            "resolutionDate": "resolution_date", "resolutionOutcome": "resolution_outcome", "category": "category"}


def model_tokens(raw):
    if not isinstance(raw, str):
        return [] if raw is None else [str(x) for x in raw] if isinstance(raw, list) else []
    try:
        parsed = json.loads(raw)
    except json.JSONDecodeError:
        return []
    return [str(x) for x in parsed if x is not None] if isinstance(parsed, list) else []


def model_bool(v):
    if v is None or isinstance(v, bool):
        return True, v
    if isinstance(v, int) and v in (0, 1):
        return True, v == 1
    if isinstance(v, str) and v.lower() in TRUE_TEXT | FALSE_TEXT:
        return True, v.lower() in TRUE_TEXT
    return False, None


def model_market(item):
    """('ok', row) or ('reject', None) for one market object."""
    if not isinstance(item.get("id"), str):
        return "reject", None
    row = {"id": item["id"]}
    for key, col in STR_KEYS.items():
        v = item.get(key)
        if v is not None and not isinstance(v, str):
            return "reject", None
        row[col] = v
    row["token_ids"] = model_tokens(item["clobTokenIds"]) if "clobTokenIds" in item else []
    out = item.get("outcomes")
    if isinstance(out, str):
        try:
            out = json.loads(out)
        except json.JSONDecodeError:
            out = None
        out = out if isinstance(out, list) else None
    elif not isinstance(out, list):
        out = None
    if out is not None and not all(isinstance(x, str) for x in out):
        return "reject", None
    row["outcomes"] = out
    for b in ("active", "closed", "archived", "resolved"):
        ok, val = model_bool(item.get(b))
        if not ok:
            return "reject", None
        row[b] = val
    if "tags" in item:
        tags = item["tags"]
        if not isinstance(tags, list) or not all(isinstance(x, str) for x in tags):
            return "reject", None
        row["tags"] = tags
    else:
        row["tags"] = []
    return "ok", row


def rand_value(rnd, kind):
    pools = {
        "str": [lambda: f"s{rnd.randrange(100)}", lambda: None, lambda: 7, lambda: True],
        "bool": [lambda: True, lambda: False, lambda: None, lambda: 1, lambda: 0, lambda: 2, lambda: 1.0,
                 lambda: "yes", lambda: "OFF", lambda: "maybe", lambda: " true"],
        "tokens": [lambda: ["a", "b"], lambda: ["a", None], lambda: [1, "x"], lambda: '["a", null, "b"]',
                   lambda: "[1, 2]", lambda: "not json", lambda: '{"a": 1}', lambda: None, lambda: 5],
        "outcomes": [lambda: ["Y", "N"], lambda: '["Y", "N"]', lambda: "bad", lambda: ["Y", 1],
                     lambda: '["Y", null]', lambda: None, lambda: 3, lambda: "[]"],
        "tags": [lambda: ["x"], lambda: [], lambda: None, lambda: "x", lambda: [1]],
    }
    return rnd.choice(pools[kind])()


def rand_market(rnd, i):
    m = {}
    if rnd.random() < 0.95:
        m["id"] = f"m{i}" if rnd.random() < 0.95 else i
    for key in STR_KEYS:
        if rnd.random() < 0.3:
            m[key] = rand_value(rnd, "str")
    for b in ("active", "closed", "archived", "resolved"):
        if rnd.random() < 0.4:
            m[b] = rand_value(rnd, "bool")
    for key, kind in (("clobTokenIds", "tokens"), ("outcomes", "outcomes"), ("tags", "tags")):
        if rnd.random() < 0.6:
            m[key] = rand_value(rnd, kind)
    if rnd.random() < 0.2:
        m["volume"] = "12.5"
    return m


def test_markets_match_model(spark):
    rnd = random.Random(77)
    pages, want_ok, want_rej = [], {}, set()
    n = 0
    for page in range(40):
        items = []
        for _ in range(rnd.randrange(0, 30)):
            items.append(rand_market(rnd, n))
            n += 1
        if rnd.random() < 0.3:
            items.append("junk")
        pages.append((page, json.dumps(items)))
        for pos, it in enumerate(items):
            if not isinstance(it, dict):
                continue
            status, row = model_market(it)
            if status == "ok":
                want_ok[(page, pos)] = row
            else:
                want_rej.add((page, pos))
    good, rej = B.decode_markets(spark.createDataFrame(pages, "page long, payload string"))
    got = {(r.page, r.pos): r.asDict() for r in good.collect()}
    assert {(r.page, r.pos) for r in rej.collect()} == want_rej
    assert set(got) == set(want_ok)
    for k, row in want_ok.items():
        g = got[k]
        for col, v in row.items():
            assert g[col] == v, (k, col, g[col], v)


# ------------------------------------------------------------------ order books

def model_levels(levels):
    out = []
    for lv in levels:
        if not isinstance(lv, dict) or "price" not in lv or "size" not in lv:
            continue
        pr, sz = lv["price"], lv["size"]
        try:
            pr = float(pr) if isinstance(pr, str) else pr
            sz = float(sz) if isinstance(sz, str) else sz
        except ValueError:
            continue
        if not isinstance(pr, (int, float)) or not isinstance(sz, (int, float)):
            continue
        out.append((float(pr), float(sz)))
    return out


def rand_level(rnd):
    if rnd.random() < 0.05:
        return rnd.choice(["x", 3, None])
    lv = {}
    for key in ("price", "size"):
        if rnd.random() < 0.93:
            lv[key] = rnd.choice([lambda: rnd.randrange(1, 99) / 100, lambda: str(rnd.randrange(1, 99) / 100),
                                  lambda: rnd.randrange(1, 50), lambda: "bad", lambda: None, lambda: True])()
    return lv


def test_books_match_model(spark):
    rnd = random.Random(5)
    rows, want = [], {}
    for i in range(200):
        bids = [rand_level(rnd) for _ in range(rnd.randrange(0, 10))]
        asks = [rand_level(rnd) for _ in range(rnd.randrange(0, 10))]
        rows.append((f"k{i}", json.dumps({"bids": bids, "asks": asks, "timestamp": str(LO + i)})))
        want[f"k{i}"] = (sorted(model_levels(bids), key=lambda x: x[0], reverse=True),
                         sorted(model_levels(asks), key=lambda x: x[0]), LO + i)
    good, rej = B.decode_orderbook(spark.createDataFrame(rows, "token_id string, payload string"))
    got = {r.token_id: ([(x.price, x.size) for x in r.bids], [(x.price, x.size) for x in r.asks], r.timestamp)
           for r in good.collect()}
    assert rej.count() == 0 and got == want

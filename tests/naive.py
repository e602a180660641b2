"""Row-by-row models that the Spark jobs are compared with."""

import random


class Empty(Exception):
    pass


def apply_listing(tracker, listing, run):
    """`tracker`: list of [name, time, url, start, end, state]; `listing`: dict name -> (time, url)."""
    tracker = [list(r) for r in tracker]
    if not listing and any(r[5] == "Y" for r in tracker):
        raise Empty
    feed, opened = [], []
    for name, version in listing.items():
        held = [r for r in tracker if r[0] == name and r[5] == "Y"]
        if held:
            same = None not in version and (held[0][1], held[0][2]) == version
            if not same:
                held[0][4:] = [run, "N"]
                opened.append([name, *version, run, None, "Y"])
                feed.append((name, "changed"))
        else:
            opened.append([name, *version, run, None, "Y"])
            feed.append((name, "new"))
    for r in tracker:
        if r[5] == "Y" and r[0] not in listing:
            r[4:] = [run, "N"]
            feed.append((r[0], "removed"))
    return [tuple(r) for r in tracker + opened], sorted(feed)


def random_history(seed, names=12, runs=9, missing=False, empty=0.0):
    rng = random.Random(seed)
    times = ["t1", "t2"] + ([None] if missing else [])
    history = {}
    for r in range(runs):
        listed = [n for n in range(names) if rng.random() < 0.75] or [0]
        if empty and rng.random() < empty:
            listed = []
        history[f"2024-{1 + r // 3:02d}-{1 + r:02d} 12:00:00"] = {
            f"f{n}": (rng.choice(times) if rng.random() < 0.4 else "t1", "u" if rng.random() < 0.8 else "v")
            for n in listed
        }
    return history


def replay(history):
    tracker = []
    for run in sorted(history):
        tracker, _ = apply_listing(tracker, history[run], run)
    return sorted(tracker, key=repr)

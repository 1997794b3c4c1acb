"""Brute force for the path reports: walk every client's ordered hits by hand.

A walk keeps the path that is open.  A conversion closes it; whatever is still
open at the end is the client's unconverted path.  Everything up to and with the
last conversion before the report's start is forgotten.
"""
from __future__ import annotations

from collections import defaultdict


def label(h: dict) -> str:
    def part(name):
        return "null" if h[name] is None else h[name]

    kind, src = h["interaction_type"], h["src"]
    tail = {"adriver": "profile", "dcm": "dcm_placement_id"}.get(src)
    if tail and kind in ("view", "click"):
        return f"{kind}:{part('utm_source')} / {part('utm_medium')} / {part('utm_campaign')}:{part(tail)}"
    if src in ("ga", "bq"):
        return part("ga_sourcemedium") + " / " + part("utm_campaign")
    if src == "seizmik":
        return "seizmik_channel"
    raise ValueError(f"no label for {src}")


def walk(touches, forget_before=None):
    """touches: (ts, converts, channel) of a client in any order -> its paths
    (list of touches, closed) in order."""
    paths, open_path = [], []
    for touch in sorted(touches):
        ts, converts, _ = touch
        open_path.append(touch)
        if converts:
            if forget_before is not None and ts < forget_before:
                paths = []
            else:
                paths.append((open_path, True))
            open_path = []
    if open_path:
        paths.append((open_path, False))
    return paths


def _wanted(h, p, since):
    return (since <= h["HitTimeStamp"] < p.finish_ms and h["ProjectID"] == p.project_id
            and h["src"] in p.source_platform and (p.product is None or h["ga_location"] == p.product))


def _clients(hits, converts):
    out = defaultdict(list)
    for h in hits:
        out[h["ClientID"]].append((h["HitTimeStamp"], converts(h), label(h)))
    return out


def _rows(clients, keep, closed, forget_before=None):
    return sorted((c, "=>".join(ch for _, _, ch in path), "=>".join(str(ts) for ts, _, _ in path))
                  for c, touches in clients.items() if c is not None and keep(touches)
                  for path, ended in walk(touches, forget_before) if ended == closed)


def canonical(hits: list[dict], p) -> list[tuple]:
    """Detail rows (client, path, timeline) for p.achieve_mode; hits with a goal
    other than a target are not seen at all."""
    seen = [h for h in hits if _wanted(h, p, p.lookback_ms) and (h["goal"] is None or h["goal"] in p.target_numbers)]
    clients = _clients(seen, lambda h: h["goal"] in p.target_numbers)

    def converted(touches):
        return any(conv and ts >= p.start_ms for ts, conv, _ in touches)

    return _rows(clients, lambda t: converted(t) == p.converted, p.converted, p.start_ms)


def v3(hits: list[dict], p) -> list[tuple]:
    """Converters' closed paths; a goal of -1 is a plain touch, other goals but
    targets are not seen."""
    seen = [h for h in hits if _wanted(h, p, p.lookback_ms) and h["goal"] in (None, -1, *p.target_numbers)]
    clients = _clients(seen, lambda h: h["goal"] not in (None, -1))
    return _rows(clients, lambda t: any(conv and ts >= p.start_ms for ts, conv, _ in t), True, p.start_ms)


def v2_pivot(hits: list[dict], p) -> dict:
    """path -> (closed, unconverted, share of all closed paths); clients without id are one client."""
    seen = [h for h in hits if _wanted(h, p, p.start_ms) and h["goal"] in (None, -1, *p.target_numbers)]
    counts = defaultdict(lambda: [0, 0])
    for touches in _clients(seen, lambda h: h["goal"] not in (None, -1)).values():
        for path, closed in walk(touches):
            counts["=>".join(ch for _, _, ch in path)][0 if closed else 1] += 1
    total = sum(yes for yes, _ in counts.values())
    return {k: (yes or None, no or None, yes / total if yes else None) for k, (yes, no) in counts.items()}


def null_report(hits: list[dict], p) -> list[tuple]:
    """The whole history in the window of clients without a target goal, as one open path."""
    seen = [h for h in hits if _wanted(h, p, p.start_ms)]
    reached = {h["ClientID"] for h in seen if h["goal"] in p.target_numbers}
    clients = _clients([h for h in seen if h["ClientID"] not in reached], lambda h: False)
    return _rows(clients, lambda t: True, False)

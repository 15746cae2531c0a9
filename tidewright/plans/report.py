"""The run report: a picture of the stages, a Mermaid chart, an HTML page and the summary as JSON."""

from __future__ import annotations

import json
import os
from html import escape
from typing import Any

from tidewright.sources.files import save_text

#: Values of each metric that the page shows.
SHOWN = 50


def svg(stages: list[dict[str, Any]]) -> str:
    """Boxes with stage, rows and note from left to right, joined by lines."""
    boxes = []
    for i, stage in enumerate(stages):
        x = 30 + 260 * i
        texts = [(str(stage["stage"]), 30, 15), (f"{stage['rows']} rows", 54, 19), (str(stage.get("note") or ""), 76, 11)]
        drawn = "".join(f'<text x="{x + 12}" y="{40 + dy}" font-size="{size}">{escape(text)}</text>' for text, dy, size in texts if text)
        line = f'<path d="M{x - 50} 85h46" stroke="#345"/>' if i else ""
        boxes.append(f'{line}<rect x="{x}" y="40" width="205" height="90" rx="8" fill="#eef3f6" stroke="#345"/>{drawn}')
    width = max(290, 60 + 260 * len(stages))
    return f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {width} 170" width="{width}" height="170" font-family="sans-serif">{"".join(boxes)}</svg>'


def mermaid(stages: list[dict[str, Any]]) -> str:
    nodes = [f'    s{i}["{str(s["stage"]).replace(chr(34), chr(39))}<br/>{s["rows"]} rows"]' for i, s in enumerate(stages)]
    return "\n".join(["flowchart LR", *nodes, *(f"    s{i} --> s{i + 1}" for i in range(len(stages) - 1))]) + "\n"


def page(stages: list[dict[str, Any]], token_values: list[float], judge_values: list[float]) -> str:
    rows = "".join(f"<tr><td>{escape(str(s['stage']))}</td><td>{s['rows']}</td><td>{s.get('duration_seconds', 0):.3f}</td><td>{escape(str(s.get('note') or ''))}</td></tr>" for s in stages)
    listed = lambda values: escape(json.dumps(values[:SHOWN]))
    return (
        '<!doctype html><html lang="en"><head><meta charset="utf-8"><title>Pipeline run</title></head><body style="font-family:sans-serif"><h1>Pipeline run</h1>'
        f"{svg(stages)}<h2>Stages</h2><table><tr><th>stage</th><th>rows</th><th>seconds</th><th>note</th></tr>{rows}</table>"
        f"<h2>Token counts (first {SHOWN})</h2><pre>{listed(token_values)}</pre><h2>Judge scores (first {SHOWN})</h2><pre>{listed(judge_values)}</pre></body></html>"
    )


def write_report(folder: str, summary: dict[str, Any], token_values: list[float], judge_values: list[float]) -> dict[str, str]:
    """The four files and their paths."""
    stages = summary.get("stages", [])
    texts = {
        "svg": ("pipeline.svg", svg(stages)),
        "mermaid": ("pipeline.mmd", mermaid(stages)),
        "html": ("report.html", page(stages, token_values, judge_values)),
        "summary_json": ("summary.json", json.dumps(summary, ensure_ascii=False, indent=2)),
    }
    paths = {}
    for key, (name, text) in texts.items():
        paths[key] = os.path.join(folder, name)
        save_text(paths[key], text)
    return paths

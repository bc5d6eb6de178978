"""What is in a snapshot, as one aligned table or as JSON, without reading its rows."""

from __future__ import annotations

import json

from tablecrate.errors import CrateError
from tablecrate.sources.manifests import ManifestObject, Snapshot

# Column heads of the object table, and what stands below each.
_HEADS = ("object", "from", "as", "columns", "rows", "checksum")


def object_row(item: ManifestObject) -> dict[str, str | int | None]:
    return dict(
        zip(
            _HEADS,
            (
                ".".join(item.target),
                ".".join(item.source),
                item.export_as if item.export_as == item.kind else f"{item.export_as} of {item.kind}",
                len(item.columns),
                item.rows,
                item.checksum,
            ),
        )
    )


def snapshot_facts(snapshot: Snapshot) -> dict:
    manifest = snapshot.manifest
    counts = [item.rows for item in manifest.objects if item.rows is not None]
    return {
        "path": snapshot.path,
        "written": manifest.written,
        "payload": {"format": manifest.payload_format, "sealed": snapshot.encrypted},
        "source": {
            "engine": manifest.engine,
            "session": manifest.session,
            "pinned": manifest.consistent,
            "files": manifest.inputs and manifest.inputs.files,
            "bytes": manifest.inputs and manifest.inputs.bytes,
        },
        "totals": {"objects": len(manifest.objects), "rows": sum(counts)},
        "layout": manifest.layout,
    }


def render_info(snapshot: Snapshot, output_format: str = "text", objects: bool = False) -> str:
    facts = snapshot_facts(snapshot)
    rows = [object_row(item) for item in snapshot.manifest.objects] if objects else []
    if output_format == "json":
        return json.dumps(facts | ({"objects": rows} if objects else {}), indent=2, ensure_ascii=False) + "\n"
    if output_format != "text":
        raise CrateError(f"info is printed as text or json, not {output_format!r}")
    payload, source, totals = facts["payload"], facts["source"], facts["totals"]
    said = [
        f"{facts['path']}: {totals['objects']} objects, {totals['rows']} rows",
        f"{payload['format']}{' sealed' if payload['sealed'] else ''}, layout {facts['layout']}, written {facts['written']}",
        f"{'pinned' if source['pinned'] else 'not pinned'} source, engine {source['engine']}, {source['session']}",
    ]
    return "\n".join(said + (["", *aligned(rows)] if rows else [])) + "\n"


def aligned(rows: list[dict]) -> list[str]:
    table = [_HEADS, *[["-" if row[head] is None else str(row[head]) for head in _HEADS] for row in rows]]
    widths = [max(len(line[i]) for line in table) for i in range(len(_HEADS))]
    return ["  ".join(cell.ljust(width) for cell, width in zip(line, widths)).rstrip() for line in table]

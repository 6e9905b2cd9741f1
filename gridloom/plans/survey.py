"""Survey configuration, derived plan, manifest, resume and report: what the driver keeps around the queries."""
from __future__ import annotations

import hashlib
import html
import json
import os
import shutil
import tomllib
from dataclasses import asdict, dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class Mission:
    name: str
    path: str


@dataclass(frozen=True)
class Survey:
    """A validated survey file."""

    name: str
    georeferencing: str | None = None
    anchor: str | None = None
    visible: tuple[Mission, ...] = ()
    multispectral: tuple[Mission, ...] = ()
    reference: str | None = None
    resolution: float | None = None
    web_map: bool = True
    publish_to: tuple[str, ...] = ()
    run_dir: str = "run"
    extra: dict = field(default_factory=dict)

    def plan(self) -> list[str]:
        """Stages in order: a scene only to calibrate to, alignment of visible missions only to an anchor."""
        calibrating = bool(self.multispectral) and (self.reference or "none").lower() != "none"
        stages = ["scene"] if calibrating else []
        if self.visible:
            stages += ["align/visible"] * bool(self.anchor) + ["stitch/visible"]
        if self.multispectral:
            stages += ["align/ms", "stitch/ms"] + ["calibrate"] * calibrating
        return stages + ["tiles"] * self.web_map + ["report"] + ["publish"] * (len(self.publish_to) == 2)

    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()


def load_environment(beside: str) -> dict[str, str]:
    """KEY=VALUE lines of a .env file beside the survey file; variables that are set already win."""
    found: dict[str, str] = {}
    path = Path(beside).with_name(".env")
    for line in path.read_text().splitlines() if path.exists() else []:
        key, eq, value = line.strip().removeprefix("export ").partition("=")
        if eq and not key.startswith("#"):
            value = value.strip()
            if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'":
                value = value[1:-1]
            found[key.strip()] = value
            os.environ.setdefault(key.strip(), value)
    return found


def load(path: str) -> Survey:
    """Read and check a TOML survey file: exactly one of georeferencing (only "gcp") and anchor, unique mission names."""
    load_environment(path)
    with open(path, "rb") as file:
        raw = tomllib.load(file)
    if bool(raw.get("georeferencing")) == bool(raw.get("anchor")):
        raise ValueError("give exactly one of georeferencing and anchor")
    if raw.get("georeferencing") not in (None, "gcp"):
        raise ValueError('georeferencing can only be "gcp"')
    missions = {}
    for kind in ("visible", "multispectral"):
        listed = [Mission(m.get("name") or Path(m["path"]).stem, m["path"]) for m in raw.get(kind, {}).get("missions", [])]
        if len({m.name for m in listed}) != len(listed):
            raise ValueError(f"two {kind} missions have one name")
        missions[kind] = tuple(listed)
    stitch, publish = raw.get("stitch", {}), raw.get("publish", {})
    return Survey(
        raw["name"], raw.get("georeferencing"), raw.get("anchor"), missions["visible"], missions["multispectral"], raw.get("calibrate", {}).get("reference"),
        stitch.get("resolution"), raw.get("web_map", True), tuple(publish[k] for k in ("data_dir", "map_dir") if publish.get(k)), raw.get("run_dir", "run"),
    )


def write_json(path: str, value: object) -> None:
    """Write beside and replace: a reader never sees half a file."""
    part = f"{path}.part"
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(part, "w") as file:
        json.dump(value, file, indent=1, sort_keys=True, default=str)
    os.replace(part, path)


def read_json(path: str) -> dict:
    return json.loads(Path(path).read_text()) if os.path.exists(path) else {}


def update_manifest(survey: Survey, **extra: object) -> dict:
    """The manifest with the survey as it is now and extra merged in; other keys stay."""
    path = f"{survey.run_dir}/manifest.json"
    now = read_json(path) | {"survey": asdict(survey), "fingerprint": survey.fingerprint()} | extra
    write_json(path, now)
    return now


def stage_done(survey: Survey, stage: str) -> bool:
    """A stage counts as done while its report stands and was made of this very survey."""
    return read_json(f"{survey.run_dir}/{stage.replace('/', '_')}.json").get("fingerprint") == survey.fingerprint()


def finish_stage(survey: Survey, stage: str, report: dict) -> None:
    write_json(f"{survey.run_dir}/{stage.replace('/', '_')}.json", report | {"stage": stage, "fingerprint": survey.fingerprint()})


def run(survey: Survey, steps: dict, rescan: bool = False) -> list[str]:
    """Run the plan's stages that are not done; a report is always built, publishing only after success. Gives stages run.

    steps: stage -> callable(survey) -> report dict. Stages scored as optional ("tiles") may fail without ending the run.
    """
    ran, failed = [], None
    for stage in survey.plan():
        if stage in ("report", "publish") or (stage_done(survey, stage) and not (rescan and stage == "scene")):
            continue
        try:
            finish_stage(survey, stage, steps[stage](survey) or {})
            ran.append(stage)
        except Exception as error:
            if stage != "tiles":
                failed = {"stage": stage, "error": str(error)}
                break
    update_manifest(survey, finished=failed is None, failed_stage=failed and failed["stage"])
    build_report(survey, failed)
    if failed:
        raise RuntimeError(f"{failed['stage']}: {failed['error']}")
    if "publish" in survey.plan() and "publish" in steps:
        steps["publish"](survey)
        ran.append("publish")
    return ran


def build_report(survey: Survey, failed: dict | None = None) -> str:
    """HTML and JSON of what the stages reported; stages without a report are shown as missing."""
    parts = {s: read_json(f"{survey.run_dir}/{s.replace('/', '_')}.json") for s in survey.plan() if s not in ("report", "publish")}
    write_json(f"{survey.run_dir}/report.json", {"survey": survey.name, "failed": failed, "stages": parts})
    rows = "".join(f"<tr><td>{html.escape(s)}</td><td>{'done' if p else 'failed' if failed and failed['stage'] == s else 'missing'}</td><td><pre>{html.escape(json.dumps({k: v for k, v in p.items() if k not in ('fingerprint', 'stage', 'vi_r2')}, indent=1, default=str))}</pre></td></tr>" for s, p in parts.items())
    path = f"{survey.run_dir}/report.html"
    Path(path).write_text(f"<!doctype html><meta charset=utf-8><title>{html.escape(survey.name)}</title><h1>{html.escape(survey.name)}</h1><table>{rows}</table>")
    return path


def publish_file(source: str, target: str) -> None:
    """Move a file: rename where that works, else copy beside, compare sizes and replace. Repeating it is harmless."""
    if not os.path.exists(source):
        if os.path.exists(target):
            return
        raise FileNotFoundError(source)
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    try:
        os.replace(source, target)
    except OSError:
        part = f"{target}.partial"
        shutil.copyfile(source, part)
        if os.path.getsize(part) != os.path.getsize(source):
            raise OSError(f"{part} is shorter than {source}") from None
        os.replace(part, target)
        os.remove(source)


def publish_tree(source: str, target: str) -> int:
    """Move a folder's files below target, one by one; what stood there before and is not in source goes. Gives files moved.

    A marker beside target lists the files to come: a run that was cut short goes on from it, and a finished one clears it.
    """
    marker = f"{target.rstrip('/')}.publishing.json"
    listed = read_json(marker).get("files")
    if listed is None:
        if not os.path.isdir(source):
            if os.path.isdir(target):
                return 0
            raise FileNotFoundError(source)
        listed = sorted(str(p.relative_to(source)) for p in Path(source).rglob("*") if p.is_file())
        write_json(marker, {"source": source, "files": listed})
    for old in [p for p in Path(target).rglob("*") if p.is_file()] if os.path.isdir(target) else []:
        if str(old.relative_to(target)) not in listed:
            old.unlink()
    moved = 0
    for name in listed:
        here = os.path.exists(f"{source}/{name}")
        publish_file(f"{source}/{name}", f"{target}/{name}")
        moved += here
    os.remove(marker)
    shutil.rmtree(source, ignore_errors=True)
    return moved

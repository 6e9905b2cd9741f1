"""What runs around the queries on a driver or a single worker: staging, claims, progress, memory, and a file server."""
from __future__ import annotations

import http.server
import os
import re
import shutil
import threading
import time
import urllib.request
from collections.abc import Callable, Iterable
from pathlib import Path

LEASE_S = 600.0


def stage_local(source: str, target: str, tries: int = 3, wait_s: float = 3.0, timeout_s: float = 120.0, fetch: Callable | None = None) -> str:
    """Copy a remote or local file beside target and put it in place; a part is never left, a copy that is there stays.

    gs:// addresses become https ones, and a /vsicurl/ prefix goes. Each failed try is followed by a wait.
    """
    if os.path.exists(target):
        return target
    address = re.sub(r"^gs://", "https://storage.googleapis.com/", source.removeprefix("/vsicurl/"))

    def plain(part: str) -> None:
        if "://" not in address:
            shutil.copyfile(address, part)
            return
        with urllib.request.urlopen(address, timeout=timeout_s) as got, open(part, "wb") as file:
            shutil.copyfileobj(got, file, 16 << 20)

    part = f"{target}.partial"
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    for left in range(tries - 1, -1, -1):
        try:
            (lambda p: fetch(address, p))(part) if fetch else plain(part)
            os.replace(part, target)
            return target
        except OSError:
            if os.path.exists(part):
                os.remove(part)
            if not left:
                raise
            time.sleep(wait_s)
    return target


class Heartbeat:
    """Touches a file at most once a second; never raises. Off unless a path is given or the variable names one."""

    def __init__(self, path: str | None = None, variable: str = "GRIDLOOM_HEARTBEAT"):
        self.path, self.last = path or os.environ.get(variable), float("-inf")

    def beat(self) -> None:
        now = time.monotonic()
        if not self.path or now - self.last < 1.0:
            return
        self.last = now
        try:
            Path(self.path).touch()
        except OSError:
            pass


class MemorySampler:
    """A thread that notes the machine's free memory and a folder's free disk every few seconds, and the least of each."""

    def __init__(self, folder: str = ".", every_s: float = 30.0, low_mb: float = 2048, low_disk_gb: float = 20, least_s: float = 5.0):
        self.folder, self.every_s, self.low_mb, self.low_disk_gb = folder, max(every_s, least_s), low_mb, low_disk_gb
        self.samples: list[tuple[float, float]] = []
        self.stop = threading.Event()
        self.thread = threading.Thread(target=self._run, daemon=True)

    @staticmethod
    def free_mb() -> float:
        found = re.search(r"MemAvailable:\s+(\d+)", Path("/proc/meminfo").read_text()) if os.path.exists("/proc/meminfo") else None
        return int(found.group(1)) / 1024 if found else float("inf")

    def sample(self) -> tuple[float, float]:
        one = (self.free_mb(), shutil.disk_usage(self.folder).free / 1e9)
        self.samples.append(one)
        return one

    def _run(self) -> None:
        self.sample()
        while not self.stop.wait(self.every_s):
            self.sample()

    def __enter__(self) -> MemorySampler:
        self.thread.start()
        return self

    def __exit__(self, *_: object) -> None:
        self.stop.set()
        self.thread.join()

    def summary(self) -> dict:
        mb, gb = (min((s[k] for s in self.samples), default=float("inf")) for k in (0, 1))
        return {"least_free_mb": mb, "least_free_disk_gb": gb, "low_memory": mb < self.low_mb, "low_disk": gb < self.low_disk_gb}


class Claims:
    """Leases on keys as files of a shared folder: made exclusively, taken over by one worker when older than the lease."""

    def __init__(self, folder: str, lease_s: float = LEASE_S):
        self.folder, self.lease_s = Path(folder), lease_s
        self.folder.mkdir(parents=True, exist_ok=True)

    def take(self, key: str, worker: str, now: float | None = None) -> bool:
        now, path = time.time() if now is None else now, self.folder / f"{key}.claim"
        try:
            with open(path, "x") as file:
                file.write(f"{worker} {now}")
            return True
        except FileExistsError:
            pass
        try:
            held = float(path.read_text().split()[-1])
        except (FileNotFoundError, IndexError, ValueError):
            return False
        if now - held < self.lease_s:
            return False
        try:  # of those who find it stale, the one whose rename succeeds goes on
            os.rename(path, self.folder / f"{key}.stale-{worker}-{held}")
        except FileNotFoundError:
            return False
        return self.take(key, worker, now)

    def release(self, key: str) -> None:
        (self.folder / f"{key}.claim").unlink(missing_ok=True)


def work(keys: Callable[[], Iterable[str]], done: Callable[[], Iterable[str]], measure: Callable[[str], None], claims: Claims, worker: str, poll_s: float = 1.0, idle_s: float = 60.0, limit_s: float | None = None, heartbeat: Heartbeat | None = None) -> int:
    """Claim and measure keys until all are done, the time limit is reached, or nothing could be claimed for idle_s. Gives keys measured.

    Work that a cluster runs needs no such loop: tasks are scheduled, retried and speculated by Spark. This is for workers
    that share nothing but a folder.
    """
    began = idle = time.monotonic()
    made = 0
    while True:
        todo = sorted(set(keys()) - set(done()))
        if not todo or (limit_s is not None and time.monotonic() - began >= limit_s):
            return made
        took = next((k for k in todo if claims.take(k, worker)), None)
        if heartbeat:
            heartbeat.beat()
        if took is None:
            if time.monotonic() - idle >= idle_s:
                return made
            time.sleep(poll_s)
            continue
        try:
            measure(took)
            made += 1
        finally:
            claims.release(took)
        idle = time.monotonic()


class RangeHandler(http.server.SimpleHTTPRequestHandler):
    """Serves files whole or by one byte range, to any origin, as tile archives need."""

    def end_headers(self) -> None:
        self.send_header("Access-Control-Allow-Origin", "*")
        self.send_header("Access-Control-Expose-Headers", "Content-Range, Content-Length")
        self.send_header("Accept-Ranges", "bytes")
        super().end_headers()

    def do_GET(self) -> None:  # noqa: N802
        asked = re.fullmatch(r"bytes=(\d*)-(\d*)", self.headers.get("Range", ""))
        path = self.translate_path(self.path)
        if not asked or not any(asked.groups()) or not os.path.isfile(path):
            return super().do_GET()
        size = os.path.getsize(path)
        first, last = asked.groups()
        start = int(first) if first else max(0, size - int(last))
        end = min(int(last), size - 1) if first and last else size - 1
        if start >= size or start > end:
            self.send_response(416)
            self.send_header("Content-Range", f"bytes */{size}")
            self.send_header("Content-Length", "0")
            self.end_headers()
            return None
        self.send_response(206)
        self.send_header("Content-Type", self.guess_type(path))
        self.send_header("Content-Range", f"bytes {start}-{end}/{size}")
        self.send_header("Content-Length", str(end - start + 1))
        self.end_headers()
        with open(path, "rb") as file:
            file.seek(start)
            left = end - start + 1
            while left:
                piece = file.read(min(left, 1 << 20))
                self.wfile.write(piece)
                left -= len(piece)
        return None

    def log_message(self, *_: object) -> None:
        pass


def serve(folder: str, port: int = 8080) -> http.server.ThreadingHTTPServer:
    """A server of a folder on this machine alone; call serve_forever() on it, or shutdown()."""
    return http.server.ThreadingHTTPServer(("127.0.0.1", port), lambda *a: RangeHandler(*a, directory=folder))

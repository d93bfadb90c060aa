"""Driver-side helpers that bring source files to a folder.

A source is an entry of the JSON catalogue that says how it is had: ``urls`` (tried in turn; ``{day}`` stands for a date),
``file`` (the name it gets), ``post`` or ``map`` (the form, or the map query, that is sent along), ``timeout`` (seconds), ``member`` (the file of an archive
that is wanted), ``pattern`` (files that are it), ``features`` (a paged service that Spark reads), or ``manual`` (what a person has to do).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile
import urllib.parse
import urllib.request
import zipfile
import zlib
from collections.abc import Callable, Iterable, Sequence
from pathlib import Path

_PIECE = 1 << 20
#: Some servers refuse the library's own name.
AGENT = "cellweave/1.0 (place analytics)"
CATALOGUE = Path(__file__).with_name("sources.json")


def _replaced(dest: Path, pieces: Iterable[bytes]) -> Path:
    """``dest`` with new content: it appears whole or, if anything fails, stays as it was."""
    dest.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=dest.parent, prefix=f".{dest.name}-")
    try:
        with os.fdopen(handle, "wb") as file:
            file.writelines(pieces)
        os.replace(name, dest)
    finally:
        Path(name).unlink(missing_ok=True)
    return dest


def download(url: str, dest: Path, post: dict[str, str] | None = None, timeout: int = 60) -> Path:
    """What ``url`` answers, at ``dest``; ``post`` is sent as a form."""
    body = urllib.parse.urlencode(post).encode() if post else None
    with urllib.request.urlopen(urllib.request.Request(url, body, {"User-Agent": AGENT}), timeout=timeout) as answer:
        return _replaced(dest, iter(lambda: answer.read(_PIECE), b""))


def first_answer(urls: Sequence[str], folder: Path, get: Callable[[str, Path], Path] = download, name: str | None = None) -> Path:
    """The file (named as the address's last part, or ``name``) of the first of ``urls`` that is in the folder or can be had; the error names what each of them said."""
    said = []
    folder.mkdir(parents=True, exist_ok=True)
    for url in urls:
        dest = folder / (name or Path(urllib.parse.urlparse(url).path).name)
        try:
            return dest if dest.is_file() else get(url, dest)
        except OSError as error:
            said.append(f"{url}: {error}")
    raise FileNotFoundError("; ".join(said) or "no address given")


def by_day(template: str, last: dt.date, days: int = 2) -> list[str]:
    """Addresses for ``last`` and the days before it, the latest first: ``{day:%Y%m%d}`` in the template is the date."""
    return [template.format(day=last - dt.timedelta(days=n)) for n in range(days)]


def _checksum(path: Path) -> int:
    crc = 0
    with path.open("rb") as file:
        while piece := file.read(_PIECE):
            crc = zlib.crc32(piece, crc)
    return crc


def unpacked(archive: Path, member: str, folder: Path) -> Path:
    """``member`` of a zip file in ``folder``, written only where size or checksum differ from the archive's directory."""
    with zipfile.ZipFile(archive) as z:
        entry = z.getinfo(member)
        dest = folder / Path(member).name
        if dest.is_file() and dest.stat().st_size == entry.file_size and _checksum(dest) == entry.CRC:
            return dest
        with z.open(entry) as source:
            return _replaced(dest, iter(lambda: source.read(_PIECE), b""))


def latest(folder: Path, pattern: str) -> Path | None:
    """The last file by name that fits ``pattern``."""
    return max(folder.glob(pattern), key=lambda p: p.name, default=None)


def map_query(box: tuple[float, float, float, float], tags: dict[str, str | None], kinds: Sequence[str] = ("node",), seconds: int = 300) -> str:
    """A query of the map's query language: elements of ``kinds`` with all ``tags`` (None: any value) in a box.

    ``box`` is (xmin, ymin, xmax, ymax); the language puts latitude first.
    """
    wanted = "".join(f"[{json.dumps(k)}]" if v is None else f"[{json.dumps(k)}={json.dumps(v)}]" for k, v in tags.items())
    where = ",".join(map(str, (box[1], box[0], box[3], box[2])))
    clauses = [f"{kind}{wanted}({where});" for kind in kinds]
    return "\n".join([f"[out:json][timeout:{seconds}];", *(clauses if len(clauses) == 1 else ["(", *clauses, ");"]), "out;"])


def data_source(key: str, catalogue: Path = CATALOGUE, override: Path | None = None) -> dict:
    """An entry of the JSON catalogue, an override file's first; both are read on each call."""
    found: dict = {}
    for path in (catalogue, override):
        if path and path.exists():
            found |= json.loads(path.read_text())
    if key not in found:
        raise ValueError(f"unknown data source {key!r}; known: {', '.join(sorted(found))}")
    return found[key]


def obtain(entry: dict, folder: Path, force: bool = False, today: dt.date | None = None, get: Callable[..., Path] = download) -> Path:
    """The file of a catalogue entry in ``folder``: what is there already (unless ``force``), else what its addresses answer.

    Without an address the file has to be there; the error then gives the entry's ``manual`` note.
    """
    if not force and (found := latest(folder, entry.get("pattern", "*.*"))):
        path = found
    elif entry.get("urls"):
        urls = [u for url in entry["urls"] for u in (by_day(url, today or dt.date.today()) if "{day" in url else [url])]
        name = entry.get("file")
        if force:
            for url in urls:
                (folder / (name or Path(urllib.parse.urlparse(url).path).name)).unlink(missing_ok=True)
        how = {k: entry[k] for k in ("post", "timeout") if k in entry}
        if "map" in entry:
            how["post"] = {"data": map_query(tuple(entry["map"]["box"]), entry["map"]["tags"])}
        path = first_answer(urls, folder, lambda url, dest: get(url, dest, **how), name)
    else:
        raise FileNotFoundError(f"nothing in {folder}: {entry.get('manual', 'no address is known')}")
    return unpacked(path, entry["member"], folder / "unpacked") if entry.get("member") else path


def data_dir() -> Path:
    return Path(os.environ.get("CELLWEAVE_DATA", "data"))

"""Driver utilities: downloads, clones and archives, with what they refuse."""

from __future__ import annotations

import hashlib
import os
import shutil
import subprocess
import tarfile
import urllib.parse
import urllib.request
import zipfile
from pathlib import Path

CHUNK = 1 << 20


def checked_url(url: str | None) -> str:
    """An http(s) URL with a host."""
    if not url:
        raise ValueError("no URL")
    parts = urllib.parse.urlparse(url)
    if parts.scheme not in ("http", "https") or not parts.netloc:
        raise ValueError(f"not an http URL with a host: {url!r}")
    return url


def checked_repository(url: str | None) -> str:
    """A repository's URL that git can't take for an option."""
    if not url or url.startswith("-"):
        raise ValueError("not a repository URL")
    parts = urllib.parse.urlparse(url)
    if parts.scheme not in ("https", "http", "ssh", "git") or not parts.netloc:
        raise ValueError(f"not a repository URL: {url!r}")
    return url


def file_sha256(path: str | os.PathLike) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(CHUNK):
            digest.update(block)
    return digest.hexdigest()


def download(url: str, dest: str | os.PathLike, *, overwrite: bool = False, timeout: int = 300) -> dict:
    """Fetch a URL to a file unless it is there; its path, size and checksum."""
    checked_url(url)
    dest = Path(dest)
    cached = dest.exists() and not overwrite
    if not cached:
        dest.parent.mkdir(parents=True, exist_ok=True)
        part = dest.with_name(dest.name + ".part")
        with urllib.request.urlopen(url, timeout=timeout) as source, part.open("wb") as out:
            shutil.copyfileobj(source, out, CHUNK)
        part.replace(dest)
    return {"url": url, "path": str(dest), "bytes": dest.stat().st_size, "sha256": file_sha256(dest), "cached": cached}


def clone(url: str, dest: str | os.PathLike, *, depth: int | None = 1, branch: str | None = None, overwrite: bool = False, timeout: int = 300) -> dict:
    """Clone a repository unless it is there; folders that aren't repositories are never removed."""
    checked_repository(url)
    if branch is not None and branch.startswith("-"):
        raise ValueError("not a branch")
    dest = Path(dest)
    if dest.exists() and overwrite:
        if not (dest / ".git").exists():
            raise ValueError(f"not a repository, so not removed: {dest}")
        shutil.rmtree(dest)
    if not dest.exists():
        command = ["git", "clone", *(["--depth", str(depth)] if depth else []), *(["--branch", branch] if branch else []), "--", url, str(dest)]
        subprocess.run(command, check=True, timeout=timeout, capture_output=True)
    head = subprocess.run(["git", "-C", str(dest), "rev-parse", "HEAD"], capture_output=True, text=True).stdout.strip()
    return {"url": url, "path": str(dest), "head": head, "bytes": folder_bytes(dest)}


def folder_bytes(path: str | os.PathLike) -> int:
    return sum(p.stat().st_size for p in Path(path).rglob("*") if p.is_file())


def _target(root: Path, name: str) -> Path:
    """Where an archive's entry goes; an error if that isn't below the root."""
    pure = name.replace("\\", "/")
    if not pure or pure.startswith("/") or (len(pure) > 1 and pure[1] == ":") or ".." in pure.split("/"):
        raise ValueError(f"unsafe path in archive: {name!r}")
    path = (root / pure).resolve()
    if path != root and root not in path.parents:
        raise ValueError(f"unsafe path in archive: {name!r}")
    return path


def extract(archive: str | os.PathLike, dest: str | os.PathLike) -> list[str]:
    """Unpack a zip or tar archive; all entries are checked before any is written."""
    archive, root = Path(archive), Path(dest).resolve()
    root.mkdir(parents=True, exist_ok=True)
    if zipfile.is_zipfile(archive):
        with zipfile.ZipFile(archive) as z:
            for info in z.infolist():
                _target(root, info.filename)
                if (info.external_attr >> 16) & 0o170000 == 0o120000:
                    raise ValueError(f"link in archive: {info.filename!r}")
            z.extractall(root)
            return z.namelist()
    if tarfile.is_tarfile(archive):
        with tarfile.open(archive) as t:
            for m in t.getmembers():
                path = _target(root, m.name)
                if m.issym() or m.islnk():
                    base = path.parent if m.issym() else root
                    goal = (base / m.linkname).resolve()
                    if os.path.isabs(m.linkname) or (goal != root and root not in goal.parents):
                        raise ValueError(f"link out of the archive: {m.name!r}")
                elif not (m.isfile() or m.isdir()):
                    raise ValueError(f"special file in archive: {m.name!r}")
            t.extractall(root, filter="data")
            return t.getnames()
    raise ValueError(f"neither a zip nor a tar archive: {archive}")


def first_match(folder: str | os.PathLike, *patterns: str) -> Path:
    """The first file, by name, that the first fitting pattern matches."""
    for pattern in patterns:
        found = sorted(Path(folder).glob(pattern))
        if found:
            return found[0]
    raise FileNotFoundError(f"none of {', '.join(patterns)} in {folder}")

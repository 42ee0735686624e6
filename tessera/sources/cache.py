"""A checksummed cache of raw files: data/..., MD5SUMS and META.json for each entry."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
import time
from pathlib import Path


def md5_of(path: Path) -> str:
    h = hashlib.md5()
    with open(path, "rb") as f:
        while chunk := f.read(1 << 20):
            h.update(chunk)
    return h.hexdigest()


def copy_verified(src: Path, dst: Path, attempts: int = 3) -> str:
    """Copy, read back what was written, and rename into place; the sum."""
    dst.parent.mkdir(parents=True, exist_ok=True)
    want, part = md5_of(src), dst.with_name(dst.name + ".part")
    for _ in range(attempts):
        shutil.copyfile(src, part)
        if md5_of(part) == want:
            os.replace(part, dst)
            return want
    part.unlink(missing_ok=True)
    raise OSError(f"{src} could not be copied intact")


def entry(root: str | Path, group: str) -> Path:
    if not re.fullmatch(r"[A-Za-z0-9][\w.-]*", group):
        raise ValueError(f"bad group name {group!r}")
    return Path(root) / group


def save(root: str | Path, group: str, files: dict[str, str | Path], meta: dict) -> Path:
    """Write an entry beside the old one and swap them; on failure the old one stays."""
    final = entry(root, group)
    new, old = final.with_name(f".{group}.new"), final.with_name(f".{group}.old")
    shutil.rmtree(new, ignore_errors=True)
    try:
        sums = {name: copy_verified(Path(src), new / "data" / name) for name, src in sorted(files.items())}
        (new / "MD5SUMS").write_text("".join(f"{s}  data/{n}\n" for n, s in sums.items()), encoding="utf-8")
        size = sum((new / "data" / n).stat().st_size for n in sums)
        (new / "META.json").write_text(json.dumps({"meta": meta, "saved_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "files": len(sums), "bytes": size}))
    except BaseException:
        shutil.rmtree(new, ignore_errors=True)
        raise
    shutil.rmtree(old, ignore_errors=True)
    if final.exists():
        os.replace(final, old)
    os.replace(new, final)
    shutil.rmtree(old, ignore_errors=True)
    return final


def verify(root: str | Path, group: str) -> list[str]:
    """What is wrong with an entry: files missing, unlisted or changed."""
    at = entry(root, group)
    if not (at / "MD5SUMS").exists():
        return ["no MD5SUMS"]
    listed = {line[34:]: line[:32] for line in (at / "MD5SUMS").read_text(encoding="utf-8").splitlines() if line}
    there = {str(p.relative_to(at)) for p in (at / "data").rglob("*") if p.is_file()}
    out = [f"missing {n}" for n in sorted(listed.keys() - there)] + [f"unlisted {n}" for n in sorted(there - listed.keys())]
    return out + [f"changed {n}" for n in sorted(listed.keys() & there) if md5_of(at / n) != listed[n]]


def restore(root: str | Path, group: str, target: str | Path, meta: dict) -> bool:
    """Put an entry's files into ``target``, which then has nothing else; False if ``meta`` isn't met or it is damaged."""
    at, target = entry(root, group), Path(target)
    if not (at / "META.json").exists() or verify(root, group):
        return False
    have = json.loads((at / "META.json").read_text())["meta"]
    if any(have.get(k) != v for k, v in meta.items()):
        return False
    names = {p.relative_to(at / "data") for p in (at / "data").rglob("*") if p.is_file()}
    for p in list(target.rglob("*")) if target.exists() else []:
        if p.is_file() and p.relative_to(target) not in names:
            p.unlink()
    for n in names:
        copy_verified(at / "data" / n, target / n)
    return True


def groups(root: str | Path) -> list[str]:
    return sorted(p.name for p in Path(root).iterdir() if (p / "META.json").exists()) if Path(root).exists() else []

"""The spark-submit program, run in a process of its own."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
TOY = "AB AC BC CA DC AB CE FG GA".split()


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    path = tmp_path_factory.mktemp("dump") / "toy.nt"
    path.write_text("".join(f"<{s}> <p> <{t}> .\n" for s, t in TOY) + "short line\n")
    return path


def run(*arguments):
    command = [sys.executable, str(ROOT / "linkrank" / "jobs" / "pagerank_job.py"), *map(str, arguments)]
    return subprocess.run(command, capture_output=True, text=True, timeout=300)


def test_distinct_drop_job(dump, tmp_path):
    done = run(dump, tmp_path / "out", "--semantics", "distinct-drop", "--top", "2", "--progress", "--num-partitions", "3")
    assert done.returncode == 0, done.stderr[-3000:]
    assert "1. <C> has rank: 0.635086\n2. <A> has rank: 0.432832\n" in done.stdout
    assert "Highest rank: <C> (0.635086)" in done.stdout
    assert "Lines without a link: 1" in done.stdout
    assert "Step 1: 5 pages\nStep 2: 4 pages" in done.stdout and "Steps done: 10" in done.stdout
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text.startswith("('<C>', 0.6350855") and text.count("\n") == 4
    again = run(dump, tmp_path / "out", "--semantics", "distinct-drop")
    assert again.returncode != 0 and "exists" in again.stderr and "Highest" not in again.stdout


def test_rows_zero_job_by_url(dump, tmp_path):
    done = run(dump, tmp_path / "out", "1", "0.85", "--layout", "by-url", "--strip-brackets", "--top", "1")
    assert done.returncode == 0, done.stderr[-3000:]
    assert "|<C> |2.133" in done.stdout
    assert (tmp_path / "out" / "domain=A").is_dir()


def test_missing_arguments():
    assert run().returncode != 0

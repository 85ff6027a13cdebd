"""Small tables with every awkward case, as a data folder for the registered queries."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest


def awkward_texts() -> list[str | None]:
    rng = random.Random(5)
    words = ["the", "of", "Baum", "and", "house", "it's", "river", "das", "Straße", "y", "nuits", "la", "42", "don't", "été", "zeta"]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", ".", ",", "\n"]) for _ in range(n))
    base = prose(120)
    near = base.split(" ")
    near[60] = "changed"
    texts: list[str | None] = [None, "", "   \n\t", "one", "two words", "Σίγμα ΟΔΟΣ İ", "<|endoftext|> in a text <|startoftext|>", "a\x1cb c d́e", "\U0001f600 👍🏽 x"]
    texts += [prose(rng.randint(3, 90)) for _ in range(30)]
    texts += [base, base, " ".join(near), " ".join(near[:-1]), base.upper()]
    texts += ["same line\n" * 4 + prose(20), "ha " * 50, ("spam!! " * 3 + "$$$ ") * 10, prose(6000), "x" * 5000]
    texts += ["Released under the MIT License.\n" + prose(15), prose(15) + "\nLicensed under the Apache License, Version 2.0.\n" + prose(5)]
    return texts


def write_tables(folder, texts, extra: bool = True):
    n = len(texts)
    ids = pa.array(range(n), pa.int64())
    columns = {
        "doc_id": ids,
        "text": pa.array(texts, pa.string()),
        "lang": pa.array([None if k % 11 == 3 else ("en", "de")[k % 2] for k in range(n)], pa.string()),
        "source": pa.array([None if k % 13 == 5 else "src0" if k % 3 else f"src{k % 7}" for k in range(n)], pa.string()),
        "n_chars": pa.array([len(t or "") for t in texts], pa.int64()),
    }
    if extra:  # names that operators use for results
        columns |= {"score": pa.array(["own"] * n), "kept": pa.array([k for k in range(n)]), "copy": pa.array(["c"] * n), "ids": pa.array([1.5] * n)}
    pq.write_table(pa.table(columns), folder / "documents.parquet")
    junk = [k for k, t in enumerate(texts) if t and ("!!" in t or "ha ha" in t)]
    marked = [k for k in range(n) if k % 2 == 0 or k in junk]
    labels = {"doc_id": [*marked, None, marked[0]] if marked else [], "quality": [*(int(k not in junk) for k in marked), 1, 1] if marked else []}
    pq.write_table(
        pa.table({"doc_id": pa.array(labels["doc_id"], pa.int64()), "quality": pa.array(labels["quality"], pa.int32()), "toxic": pa.array([0] * len(labels["doc_id"]), pa.int32())}),
        folder / "labels.parquet",
    )
    big, small = "<p>ä" + "y" * 1200, "<p>short"
    html = [big, small, small, None, "", big, big + "z", "a\r\n\r\nWARC/1.1\r\nb" * 100, "é" * 600, "é" * 600][:n]
    urls = ["https://WWW.Example.ORG/en/1?q", "http://a.example.org/es/7#x", None, "no scheme", "http://x.com/fr/1", "http://x.com/de/2", "ftp://org", "http://cheap-pills.net/p\n", "https://example.org/en/2", "://?"][:n]
    pq.write_table(
        pa.table({"page_id": pa.array(range(len(html)), pa.int64()), "url": pa.array(urls[: len(html)], pa.string()), "html": pa.array(html, pa.string())}),
        folder / "pages.parquet",
    )


@pytest.fixture(scope="session")
def awkward(tmp_path_factory):
    folder = tmp_path_factory.mktemp("awkward")
    write_tables(folder, awkward_texts())
    return str(folder)


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    write_tables(folder, [])
    return str(folder)


@pytest.fixture(scope="session")
def texts():
    return awkward_texts()

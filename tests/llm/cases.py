"""Small tables for the tests: rows of the smallest size and rows that are hard in some way."""

import pyarrow as pa
import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]
LONG = " ".join(f"word{i % 7919} of{i % 13}" for i in range(40_000))

# (doc_id, text, lang, source): NULLs, empty and blank texts, copies, one very long text, odd white space, other scripts.
HARD = [
    (900_001, None, "en", "src1"),
    (900_002, "", "en", "src1"),
    (900_003, " \n\t\r\n ", None, "src2"),
    (900_004, "one two three", "en", None),
    (900_005, "one two three", "en", None),
    (900_006, LONG, "en", "src3"),
    (900_007, LONG + " tail", "en", "src4"),
    (900_008, "A\u00a0B c\x0bd\x0ce \u00c4\u00d6\u00fc \U0001f600 x" * 9, "de", "src5"),
    (900_009, "a" * 400, "en", "src6"),
    (900_010, "a" * 300, "en", "src7"),
    (900_011, "# * $ % & | < > " * 30, "en", "src8"),
    (900_012, "same line here\n" * 40, "en", "src9"),
    (900_013, "\x00 nul and \x7f del " * 10, "en", "src9"),
]
# Names that operators use themselves.
CLASHES = ["kept", "score", "component_id", "fp", "row", "host", "positions", "text_key", "n_words", "weight", "units", "tag", "drawn", "topic", "n_tokens", "probability"]


def documents(rows=HARD, base=True) -> pa.Table:
    table = pq.read_table(f"{SMALL}/documents.parquet")
    ids, texts, langs, sources = (list(c) for c in zip(*rows)) if rows else ([], [], [], [])
    sizes = [None if t is None else len(t) for t in texts]
    more = pa.table([ids, texts, langs, sources, sizes], schema=table.schema)
    whole = pa.concat_tables([table, more]) if base else more
    for name in CLASHES:
        whole = whole.append_column(name, pa.array(["x"] * len(whole), pa.string()))
    return whole


def folder(path, docs: pa.Table, **tables) -> str:
    """A folder of tables: ``docs``, the given ones, the others as they are in the smallest size."""
    for name in TABLES:
        table = docs if name == "documents" else tables.get(name, None)
        pq.write_table(pq.read_table(f"{SMALL}/{name}.parquet") if table is None else table, f"{path}/{name}.parquet")
    return str(path)


def empty(name: str) -> pa.Table:
    return pq.read_table(f"{SMALL}/{name}.parquet").slice(0, 0)

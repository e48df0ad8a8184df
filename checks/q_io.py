"""Sources, sinks and streams: data derived from the tables is written and read back."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F

from checks.registry import query
from checks.views import FACTS_SQL, RUNS_SQL, cells, cells_sql, facts, norm_sql, run_lines, table
from gridloom.model import CELLS
from gridloom.operators import growth
from gridloom.operators.kpi import run_ids
from gridloom.operators.resolvers import table_resolver
from gridloom.session import scratch_path
from gridloom.sinks.archive import archive_name, file_system
from gridloom.sinks.dictionaries import HEADER_KEYS, VALUE_KEYS, DictionaryStore
from gridloom.sinks.store import Store
from gridloom.sources import dictionaries as D
from gridloom.sources.files import latest_file, list_files
from gridloom.sources.records import run_records
from gridloom.sources.workbooks import load_workbooks
from gridloom.streaming.new_files import append_once, grow_dictionary, process_new_files

# Files


def _listing(spark, sf):
    """A folder listing: one file per event, changed when the event happened."""
    ending = F.when(F.col("event_id") % 5 == 0, ".csv").otherwise(".xlsx")
    return table(spark, sf, "events").select(
        F.concat(F.lit("/inbox/f"), "event_id", ending).alias("path"),
        F.col("ts").alias("modificationTime"),
        F.lit(10).cast("long").alias("length"),
    )


@query(
    "list_files",
    """SELECT '/inbox/f' || event_id || '.xlsx' AS path, 'f' || event_id || '.xlsx' AS file_name
       FROM events WHERE event_id % 5 <> 0""",
)
def listed_files(spark, sf):
    return list_files(_listing(spark, sf)).select("path", "file_name")


@query(
    "latest_file",
    """SELECT '/inbox/f' || event_id || '.xlsx' AS path FROM events WHERE event_id % 5 <> 0
       ORDER BY ts DESC, path LIMIT 1""",
)
def latest(spark, sf):
    return latest_file(_listing(spark, sf)).select("path")


@query(
    "file_budget",
    """SELECT '/inbox/f' || event_id || CASE WHEN event_id % 5 = 0 THEN '.csv' ELSE '.xlsx' END AS path
       FROM events ORDER BY 1 LIMIT 3""",
)
def file_budget(spark, sf):
    return growth.file_budget(_listing(spark, sf), 3).select("path")


@query(
    "archive_names",
    """SELECT event_id, 'f' || event_id || CASE WHEN event_id % 3 = 0 THEN '' ELSE '_' || user_id END
              || strftime(ts, '_%Y%m%d_%H%M%S') || CASE WHEN event_id % 5 = 0 THEN '.csv' ELSE '.xlsx' END
              AS name FROM events""",
)
def archive_names(spark, sf):
    ending = F.when(F.col("event_id") % 5 == 0, ".csv").otherwise(".xlsx")
    chrono = F.when(F.col("event_id") % 3 != 0, F.col("user_id"))
    path = F.concat(F.lit("/inbox/f"), "event_id", ending)
    return table(spark, sf, "events").select(
        "event_id", archive_name(path, chrono, F.col("ts")).alias("name")
    )


# Workbooks


def _letters(col: int) -> str:
    text = ""
    while col:
        col, rest = divmod(col - 1, 26)
        text = chr(65 + rest) + text
    return text


def _part(rows: dict[int, dict[int, str]], shared: dict[str, int]) -> str:
    """Sheet XML: even columns use the shared texts, odd ones hold theirs inline."""
    lines = []
    for r, row in sorted(rows.items()):
        line = []
        for c, value in sorted(row.items()):
            if c % 2 == 0:
                index = shared.setdefault(value, len(shared))
                line.append(f'<c r="{_letters(c)}{r}" t="s"><v>{index}</v></c>')
            else:
                text = f'<is><t xml:space="preserve">{escape(value)}</t></is>'
                line.append(f'<c r="{_letters(c)}{r}" t="inlineStr">{text}</c>')
        lines.append(f'<row r="{r}">{"".join(line)}</row>')
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    return f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>'


def workbook_bytes(sheets: dict[str, dict[int, dict[int, str]]]) -> bytes:
    """A minimal workbook for ``{sheet name: {row: {column: text}}}``."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    shared: dict[str, int] = {}
    parts = [_part(rows, shared) for rows in sheets.values()]
    listed = "".join(
        f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1)
    )
    links = "".join(
        f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(parts) + 1)
    )
    texts = "".join(f'<si><t xml:space="preserve">{escape(t)}</t></si>' for t in shared)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{listed}</sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}">{links}</Relationships>'
        )
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{texts}</sst>')
        for i, part in enumerate(parts, 1):
            book.writestr(f"xl/worksheets/sheet{i}.xml", part)
    return buffer.getvalue()


def _encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            grid = {
                r: {c: v for c, v in enumerate(line.split(","), 1) if v}
                for r, line in enumerate(text.split("\n"), 1)
            }
            content = b"no workbook" if doc_id % 100 == 9 else workbook_bytes({"Feuille": grid})
            rows.append((f"/inbox/{doc_id}.xlsx", content))
        yield pd.DataFrame(rows, columns=["path", "content"])


def _workbooks(spark, sf):
    """Each document as the bytes of a workbook; some files are broken.

    Control characters have no place in XML, so such texts lose them first.
    """
    text = F.regexp_replace("text", r"[\x00-\x08\x0b-\x1f]", " ")
    documents = table(spark, sf, "documents").select("doc_id", text.alias("text"))
    # A folder of workbooks would spread by file; here the documents are spread.
    documents = documents.repartition(2 * spark.sparkContext.defaultParallelism, "doc_id")
    return documents.mapInPandas(_encode, "path string, content binary")


_PLAIN = r"regexp_replace(text, '[\x00-\x08\x0b-\x1f]', ' ', 'g')"
_BOOKS = cells_sql().replace("string_split(text,", f"string_split({_PLAIN},")


@query(
    "read_workbooks",
    f"""WITH {_BOOKS} SELECT '/inbox/' || sheet_idx || '.xlsx' AS file_id, row_idx, col_idx, value
        FROM cells WHERE sheet_idx % 100 <> 9""",
)
def workbooks(spark, sf):
    found = load_workbooks(_workbooks(spark, sf))
    return found.cells.select("file_id", "row_idx", "col_idx", "value")


@query(
    "workbook_sheets",
    f"""WITH {_BOOKS} SELECT '/inbox/' || sheet_idx || '.xlsx' AS file_id, 'Feuille' AS sheet_name,
               max(row_idx) AS max_row, max(col_idx) AS max_col
        FROM cells WHERE sheet_idx % 100 <> 9 GROUP BY ALL
        UNION ALL SELECT '/inbox/' || doc_id || '.xlsx', 'unreadable', 0, 0
        FROM documents WHERE doc_id % 100 = 9""",
)
def workbook_sheets(spark, sf):
    """Extents of the sheets, and the files that could not be read."""
    found = load_workbooks(_workbooks(spark, sf))
    broken = found.rejected.select(
        "file_id",
        F.lit("unreadable").alias("sheet_name"),
        F.lit(0).cast("long").alias("max_row"),
        F.lit(0).cast("long").alias("max_col"),
    )
    return found.sheets.drop("sheet_idx").unionByName(broken)


# Dictionaries


def _pairs(spark, sf):
    part = table(spark, sf, "part")
    return part.groupBy(F.col("p_name").alias("a")).agg(F.max("p_brand").alias("b"))


@query(
    "read_dictionaries",
    f"""WITH p AS (SELECT p_name AS a, max(p_brand) AS b FROM part GROUP BY 1)
        SELECT 'header' AS kind, '' AS field, 'É ' || a || ', "x"' AS raw, b AS standard FROM p
        UNION ALL SELECT 'by_norm', '', {norm_sql("'É ' || a || ', \"x\"'")}, b FROM p
        UNION ALL SELECT 'all_norm', '', {norm_sql("'É ' || a || ', \"x\"'")}, lower(b) FROM p
        UNION ALL SELECT 'value', 'type_inject', a, b FROM p
        UNION ALL SELECT 'pair', '', a, b FROM p
        UNION ALL SELECT 'json', 'type_inject', a, b FROM p""",
)
def read_dictionaries(spark, sf):
    base, pairs = scratch_path(spark, "dictionaries"), _pairs(spark, sf)
    raw = F.concat(F.lit("É "), "a", F.lit(', "x"'))
    csv = {"header": True, "escape": '"'}
    pairs.select(raw.alias("En-tête"), "b").write.options(**csv).csv(f"{base}/headers")
    pairs.select(F.lit("type_inject").alias("c"), "a", "b").write.options(**csv).csv(f"{base}/values")
    pairs.select("a", "b").write.csv(f"{base}/pairs")
    nested = F.to_json(F.create_map(F.lit("type_inject"), F.create_map("a", "b")))
    pairs.select(nested.alias("value")).write.text(f"{base}/json")

    def shown(df, kind, raw, field=None):
        return df.select(
            F.lit(kind).alias("kind"),
            (F.lit("") if field is None else F.col(field)).alias("field"),
            F.col(raw).alias("raw"),
            "standard",
        )

    parts = [
        shown(D.header_dictionary(spark, f"{base}/headers"), "header", "raw"),
        shown(D.header_dictionary_by_norm(spark, f"{base}/headers"), "by_norm", "norm"),
        shown(D.header_dictionary_all_norm(spark, f"{base}/headers"), "all_norm", "norm"),
        shown(D.value_dictionary(spark, f"{base}/values"), "value", "raw", "field"),
        shown(D.pair_dictionary(spark, f"{base}/pairs"), "pair", "raw"),
        shown(D.value_dictionary_json(spark, f"{base}/json"), "json", "raw", "field"),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "dictionary_versions",
    """WITH p AS (SELECT p_name AS raw, max(p_brand) AS b, max(p_size) AS s FROM part GROUP BY 1)
       SELECT raw, CASE WHEN s > 45 THEN 'size ' || s ELSE b END AS standard, 2 AS version FROM p""",
)
def dictionary_versions(spark, sf):
    """A second version replaces some entries; adding nothing writes no third one."""
    store = DictionaryStore(spark, scratch_path(spark, "dictionary"), HEADER_KEYS)
    part = table(spark, sf, "part").groupBy(F.col("p_name").alias("raw")).agg(
        F.max("p_brand").alias("standard"), F.max("p_size").alias("size")
    )
    store.add(part.select("raw", "standard"))
    store.add(part.where("size > 45").select("raw", F.concat(F.lit("size "), "size").alias("standard")))
    store.add(part.where("false").select("raw", "standard"))
    return store.read().select("raw", "standard", F.lit(store.table.version()).alias("version"))


# Tables

def _accepted(spark, sf):
    """Facts with unique keys: the smallest row per key, and no null parent."""
    rows = facts(spark, sf).where(F.col("id_chronogramme").isNotNull() & F.col("id_inject").isNotNull())
    return rows.dropDuplicates(["id_chronogramme", "id_inject"]).select(
        "id_chronogramme", "id_inject", "etablissement_nom"
    )


_ACCEPTED = f"""{FACTS_SQL}, kept AS (
    SELECT DISTINCT id_chronogramme, id_inject, etablissement_nom FROM facts
    WHERE id_chronogramme IS NOT NULL AND id_inject IS NOT NULL)"""


def _loaded(spark, sf):
    store = Store(spark, scratch_path(spark, "store"))
    store.create()
    rows = _accepted(spark, sf)
    low = F.col("id_chronogramme") < 120
    store.append_facts(rows.where(low), "b1")
    store.append_facts(rows.where(~low), "b2")
    # The second batch again: it replaces itself.
    store.append_facts(rows.where(~low), "b2")
    return store


@query(
    "append_facts",
    f"""WITH {_ACCEPTED}
        SELECT id_chronogramme, id_inject, NULL AS horodatage, etablissement_nom,
               CASE WHEN id_chronogramme < 120 THEN 'b1' ELSE 'b2' END AS batch_id FROM kept""",
)
def append_facts(spark, sf):
    return _loaded(spark, sf).facts().select(
        "id_chronogramme", "id_inject", "horodatage", "etablissement_nom", "batch_id"
    )


@query(
    "fact_ids",
    f"""WITH {_ACCEPTED}, b AS (
          SELECT CASE WHEN id_chronogramme < 120 THEN 'b1' ELSE 'b2' END AS batch_id, count(*) AS n
          FROM kept GROUP BY 1)
        SELECT batch_id, n, n AS n_ids, CAST(sum(n) OVER (ORDER BY batch_id) AS BIGINT) AS last_id
        FROM b""",
)
def fact_ids(spark, sf):
    """Generated ids are unique and go on from batch to batch."""
    ids = F.col("id_inject_global")
    return _loaded(spark, sf).facts().groupBy("batch_id").agg(
        F.count("*").alias("n"), F.count_distinct(ids).alias("n_ids"), F.max(ids).alias("last_id")
    )


@query("facts_of_one", f"WITH {_ACCEPTED} SELECT id_chronogramme, id_inject FROM kept WHERE id_chronogramme = 42")
def facts_of_one(spark, sf):
    return _loaded(spark, sf).facts(42).select("id_chronogramme", "id_inject")


@query(
    "update_counts",
    f"""WITH {_ACCEPTED}
        SELECT c_custkey AS id_chronogramme, c_name AS nom_chronogramme, count(id_inject) AS nb_injects
        FROM customer LEFT JOIN kept ON id_chronogramme = c_custkey GROUP BY ALL""",
)
def update_counts(spark, sf):
    store = _loaded(spark, sf)
    customer = table(spark, sf, "customer")
    dimension = customer.select(
        F.col("c_custkey").alias("id_chronogramme"), F.col("c_name").alias("nom_chronogramme")
    )
    even = F.col("id_chronogramme") % 2 == 0
    store.append_dimension(dimension.where(even))
    store.append_dimension(dimension.where(~even))
    store.update_counts()
    return store.dimension().select("id_chronogramme", "nom_chronogramme", "nb_injects")


def _write_logs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come run by run, in line order: one file is open at a time, whatever its length."""
    place = out = None
    try:
        for batch in batches:
            for path, lines in batch.groupby("path", sort=False)["line"]:
                if path != place:
                    if out is not None:
                        out.close()
                    system, name = file_system(path)
                    if place is None:
                        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                    place, out = path, system.open_output_stream(name)
                out.write("".join(f"{line}\n" for line in lines).encode())
            yield batch[["path"]].drop_duplicates()
    finally:
        if out is not None:
            out.close()


@query(
    "monitor_written_logs",
    f"""WITH {RUNS_SQL} SELECT log_name, chrono_id FROM runs""",
)
def monitor_written_logs(spark, sf):
    """Run logs written as one file of text per run, read back in line order."""
    base = scratch_path(spark, "run_logs")
    path = F.concat(F.lit(f"{base}/"), "log_name").alias("path")
    lines = run_lines(spark, sf).select(path, "ord", "line")
    ordered = lines.repartition("path").sortWithinPartitions("path", "ord").select("path", "line")
    ordered.mapInPandas(_write_logs, "path string").write.format("noop").mode("overwrite").save()
    return run_ids(run_records(spark, base))


# Streams


@query(
    "stream_new_files",
    f"""WITH {cells_sql()} SELECT file_id, sheet_idx, count(*) AS n FROM cells GROUP BY ALL""",
)
def stream_new_files(spark, sf):
    """Cell files arrive in two waves; the second call sees only the second wave."""
    base = scratch_path(spark, "stream")
    source = cells(spark, sf).withColumn("sheet_idx", F.col("sheet_idx").cast("long"))
    early = F.col("sheet_idx") % 3 == 0

    def handle(batch, batch_id):
        batch.groupBy("file_id", "sheet_idx").count().write.mode("overwrite").parquet(
            f"{base}/out/batch={batch_id}"
        )

    for wave in (source.where(early), source.where(~early)):
        wave.select(*CELLS.names).write.mode("append").parquet(f"{base}/in")
        process_new_files(
            spark, f"{base}/in", handle, f"{base}/checkpoint", CELLS, "parquet", f"{base}/archive"
        )
    done = spark.read.parquet(f"{base}/out")
    return done.groupBy("file_id", "sheet_idx").agg(F.sum("count").alias("n"))


_ANSWER = "CASE WHEN length(p_name) % 3 <> 0 THEN 'Std ' || (length(p_name) % 4) END"


@query(
    "stream_dictionary",
    f"""SELECT DISTINCT 'name' AS field, {norm_sql('p_name')} AS raw, {_ANSWER} AS standard
        FROM part WHERE {_ANSWER} IS NOT NULL""",
)
def stream_dictionary(spark, sf):
    """The dictionary learns from each batch; later batches find the earlier answers."""
    base = scratch_path(spark, "stream_dictionary")
    part = table(spark, sf, "part")
    size = F.length("p_name")
    names = part.select("p_name", size.alias("n")).distinct()
    reviewed = names.where(size % 3 != 0).select(
        F.lit("name").alias("scope"),
        F.lower("p_name").alias("key"),
        F.concat(F.lit("Std "), size % 4).alias("standard"),
    )
    store = DictionaryStore(spark, f"{base}/dictionary", VALUE_KEYS)
    rows = part.select(
        (F.col("p_partkey") % 5).cast("string").alias("file_id"),
        F.col("p_partkey").alias("row_idx"),
        F.lit("name").alias("field"),
        F.col("p_name").alias("value"),
    )
    for turn in range(2):
        wave = rows.where(F.col("row_idx") % 2 == turn)
        wave.coalesce(1).write.mode("append").parquet(f"{base}/in")
        process_new_files(
            spark,
            f"{base}/in",
            grow_dictionary(store, table_resolver(reviewed), {}),
            f"{base}/checkpoint",
            "file_id string, row_idx bigint, field string, value string",
            "parquet",
        )
    return store.read().select("field", "raw", "standard")


@query(
    "stream_dedup",
    f"""WITH {FACTS_SQL}, f AS (SELECT *, row_idx % 2 AS wave FROM facts
                                WHERE id_chronogramme IS NOT NULL),
        firsts AS (
          SELECT id_chronogramme, id_inject, horodatage FROM f WHERE id_inject IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY id_chronogramme, id_inject ORDER BY wave, horodatage) = 1)
        SELECT * FROM firsts
        UNION ALL SELECT id_chronogramme, id_inject, horodatage FROM f WHERE id_inject IS NULL""",
)
def stream_dedup(spark, sf):
    """Two waves with overlapping keys: a key is loaded once, rows without inject id always."""
    base = scratch_path(spark, "stream_dedup")
    store = Store(spark, f"{base}/store")
    store.create()
    rows = facts(spark, sf).where(F.col("id_chronogramme").isNotNull())
    schema = "id_chronogramme bigint, id_inject string, horodatage string"
    for turn in range(2):
        wave = rows.where(F.col("row_idx") % 2 == turn).select("id_chronogramme", "id_inject", "horodatage")
        wave.write.mode("append").parquet(f"{base}/in")
        process_new_files(spark, f"{base}/in", append_once(store, "waves"), f"{base}/checkpoint", schema, "parquet")
    return store.facts().select("id_chronogramme", "id_inject", "horodatage")


@query(
    "stream_two_sources",
    f"""WITH {FACTS_SQL} SELECT DISTINCT id_chronogramme, id_inject FROM facts
        WHERE id_chronogramme IS NOT NULL AND id_inject IS NOT NULL""",
)
def stream_two_sources(spark, sf):
    """Two folders with checkpoints of their own fill one store; each counts its batches from 0."""
    base = scratch_path(spark, "stream_two_sources")
    store = Store(spark, f"{base}/store")
    store.create()
    rows = facts(spark, sf).where("id_chronogramme IS NOT NULL AND id_inject IS NOT NULL")
    schema = "id_chronogramme bigint, id_inject string"
    for turn, name in enumerate(("north", "south")):
        part = rows.where(F.col("row_idx") % 2 == turn).select("id_chronogramme", "id_inject")
        part.write.parquet(f"{base}/{name}")
        process_new_files(
            spark, f"{base}/{name}", append_once(store, name), f"{base}/cp-{name}", schema, "parquet"
        )
    return store.facts().select("id_chronogramme", "id_inject")

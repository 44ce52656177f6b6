"""Reports: a page for each case, rendered by the executors from sorted rows and put in place when all are written."""

from __future__ import annotations

import html
import json
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from urllib.parse import quote
from uuid import uuid4

from pyarrow import fs
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from claimloom.sources.artifacts import script_safe

_STYLE = "body{font-family:sans-serif;margin:1rem}table{border-collapse:collapse}td,th{border:1px solid #ccc;padding:.3rem;text-align:left;vertical-align:top}fieldset{display:inline-block;vertical-align:top}label{display:block}"
#: What the page does: facets hide rows, modes order them, and a search looks into their text.
_SCRIPT = """const body = document.querySelector('tbody'), rows = [...body.rows], boxes = [...document.querySelectorAll('input[type=checkbox]')];
const order = document.querySelector('select'), search = document.querySelector('input[type=search]');
function show() {
  const chosen = {};
  for (const box of boxes) if (box.checked) (chosen[box.name] ??= new Set()).add(box.value);
  const asked = search.value.toLowerCase();
  for (const row of rows) row.hidden = Object.entries(chosen).some(([at, values]) => !values.has(row.cells[at].textContent)) || !row.textContent.toLowerCase().includes(asked);
}
function sorted() {
  const keys = order.value.split(',').filter(Boolean).map(Number);
  const far = (row, at) => row.dataset['r' + at] ?? row.cells[at].textContent;
  const compared = (a, b) => keys.reduce((found, at) => found || far(a, at).localeCompare(far(b, at), undefined, {numeric: true}), 0);
  for (const row of keys.length ? [...rows].sort(compared) : rows) body.append(row);
}
boxes.forEach(box => box.onchange = show); search.oninput = show; order.onchange = sorted;"""


@dataclass
class _Written(WriterCommitMessage):
    folder: str
    names: list[str]


def file_name(case: object) -> str:
    return quote(str(case), safe=" ")[:200] + ".html"


def page(title: str, columns: list[str], rows: Iterable[dict], facets: list[str], modes: dict[str, list[str]], ranks: dict[str, list[str]]) -> Iterator[str]:
    """A self-contained page in parts; rows pass once, and of them only the counts of facets are held.

    ``modes`` names orders by columns (the rows' own comes first); values of a column in ``ranks`` go in its order.
    """
    e = lambda x: html.escape("" if x is None else str(x))
    choices = "".join(f"<option value='{','.join(str(columns.index(c)) for c in by)}'>{e(name)}</option>" for name, by in {"as given": [], **modes}.items())
    yield f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{e(title)}</title><style>{_STYLE}</style></head><body><h1>{e(title)}</h1><p><input type='search' placeholder='Search'> <select>{choices}</select></p>"
    yield f"<table><thead><tr>{''.join(f'<th>{e(c)}</th>' for c in columns)}</tr></thead><tbody>"
    counts, places = {c: Counter() for c in facets}, {c: {v: n for n, v in enumerate(values)} for c, values in ranks.items()}
    for row in rows:
        for c in facets:
            counts[c][row[c]] += 1
        rank = "".join(f" data-r{columns.index(c)}='{place.get(row[c], len(place))}'" for c, place in places.items())
        yield f"<tr{rank}>{''.join(f'<td>{e(row[c])}</td>' for c in columns)}</tr>\n"
    yield "</tbody></table>"
    told = {}
    for c, found in counts.items():
        place = places.get(c, {})
        told[c] = sorted(found.items(), key=lambda x: (place.get(x[0], len(place)), str(x[0])))
        yield f"<fieldset><legend>{e(c)}</legend>{''.join(f'<label><input type=checkbox name={columns.index(c)} value="{e(v)}"> {e(v)} ({n})</label>' for v, n in told[c])}</fieldset>"
    yield f"<script type='application/json' id='facets'>{script_safe(told)}</script><script>{_SCRIPT}</script></body></html>\n"


class _PageWriter(DataSourceWriter):
    """Each task writes its cases into a folder of its own; the driver moves them when every task is done."""

    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.case, self.overwrite = options["path"].rstrip("/"), options["case"], overwrite
        self.facets, self.modes, self.ranks = (json.loads(options[k]) for k in ("facets", "modes", "ranks"))
        self.columns = [f.name for f in schema.fields if f.name != self.case]
        self.run = f"_pages-{uuid4().hex}"

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")

    def write(self, iterator: Iterator[Row]) -> _Written:
        files, root = self._place()
        folder, names = f"{root}/{self.run}/{uuid4().hex}", []
        files.create_dir(folder)
        for case, rows in groupby(iterator, lambda r: r[self.case]):
            names.append(file_name(case))
            with files.open_output_stream(f"{folder}/{names[-1]}") as out:
                for part in page(str(case), self.columns, (r.asDict() for r in rows), self.facets, self.modes, self.ranks):
                    out.write(part.encode())
        return _Written(folder, names)

    def commit(self, messages: list[_Written | None]) -> None:
        files, root = self._place()
        if self.overwrite:
            for old in files.get_file_info(fs.FileSelector(root)):
                if old.base_name.endswith(".html"):
                    files.delete_file(old.path)
        for message in filter(None, messages):
            for name in message.names:
                files.move(f"{message.folder}/{name}", f"{root}/{name}")
        self._clear(files, root)

    def abort(self, messages: list[_Written | None]) -> None:
        self._clear(*self._place())

    def _clear(self, files: fs.FileSystem, root: str) -> None:
        if files.get_file_info(f"{root}/{self.run}").type != fs.FileType.NotFound:
            files.delete_dir(f"{root}/{self.run}")


class CasePages(DataSource):
    """The format ``case_pages``: writes a page for each value of the option ``case``, whose rows come together in a partition."""

    @classmethod
    def name(cls) -> str:
        return "case_pages"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _PageWriter(self.options, schema, overwrite)


def write_reports(df: DataFrame, folder: str, case: str, order: Iterable[str] = (), facets: Iterable[str] = (), modes: dict[str, list[str]] | None = None, ranks: dict[str, list[str]] | None = None, overwrite: bool = True) -> None:
    """A page ``<case>.html`` in ``folder`` for each case of ``df``, its rows by ``order``; nothing of it reaches the driver but file names.

    ``folder`` is one that the driver and all executors share. A page is one file, so its rows pass through one task, which
    holds none of them. Pages appear when all are written; those of a run that fails go.
    """
    df.sparkSession.dataSource.register(CasePages)
    order, facets = list(order), list(facets)
    shown = df.select(*(F.col(c) if t in ("string", "int", "bigint", "boolean", "double", "float", "smallint", "tinyint") else F.to_json(F.struct(c)).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c).cast("string").alias(c) for c, t in df.dtypes))
    dealt = shown.repartition(case).sortWithinPartitions(case, *order)
    options = {"path": folder, "case": case, "facets": json.dumps(facets), "modes": json.dumps(modes or {}), "ranks": json.dumps(ranks or {})}
    dealt.write.format(CasePages.name()).options(**options).mode("overwrite" if overwrite else "append").save()

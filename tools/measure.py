"""Throughput of the scans and of upsert on generated input: python tools/measure.py [zips]"""

import json
import sys
import tempfile
import time
import zipfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from assetlake.operators.mappings import derive_content  # noqa: E402
from assetlake.operators.merge import upsert  # noqa: E402
from assetlake.operators.taskflows import shred_taskflows  # noqa: E402
from assetlake.session import local_session  # noqa: E402
from assetlake.sources import archives  # noqa: E402
from assetlake.sources.taskflow_xml import NAMESPACES, scan_taskflow_xml  # noqa: E402


def timed(frame) -> float:
    start = time.perf_counter()
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median_of_3(frame) -> float:
    return sorted(timed(frame) for _ in range(3))[1]


def write_zips(folder: Path, count: int) -> None:
    items = [{"$$ID": f"T{i}", "name": f"src_{i}", "fields": list(range(40))} for i in range(10)]
    for n in range(count):
        body = {"content": {"$$IID": f"M{n}", "name": f"m_p_x_684_{n}", "transformations": items}}
        with zipfile.ZipFile(folder / f"{n}.DTEMPLATE.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("@3.bin", json.dumps(body))


def write_flows(folder: Path, count: int, items: int) -> None:
    spaces = " ".join(f'xmlns:{k}="{v}"' for k, v in NAMESPACES.items())
    service = '<ns0:service id="s"><ns0:title>t</ns0:title></ns0:service>' * 5
    for n in range(count):
        item = "".join(
            f"<types1:Item><types1:EntryId>E{n}_{i}</types1:EntryId><types1:Entry><ns0:taskflow>"
            f"<ns0:flow><ns0:eventContainer>{service}</ns0:eventContainer></ns0:flow>"
            "</ns0:taskflow></types1:Entry></types1:Item>"
            for i in range(items)
        )
        (folder / f"{n}.xml").write_text(f"<r {spaces}>{item}</r>")


def main() -> None:
    spark, results = local_session(8, "16g"), {}
    for count in [int(n) for n in sys.argv[1:]] or [1000, 10_000]:
        folder = Path(tempfile.mkdtemp(prefix="run-"))
        write_zips(folder, count)
        docs = archives.scan_archives(spark, str(folder), *archives.MAPPINGS)
        seconds = median_of_3(derive_content(docs, "2024-01-01 00:00:00"))
        results[f"archives_{count}_docs_per_s"] = round(count / seconds)
    folder = Path(tempfile.mkdtemp(prefix="run-"))
    write_flows(folder, 1000, 10)
    service = shred_taskflows(scan_taskflow_xml(spark, str(folder)))["Service"]
    results["taskflow_items_per_s"] = round(10_000 / median_of_3(service))
    target = spark.range(1_000_000).selectExpr("id AS k", "uuid() AS v", "id AS first")
    updates = spark.range(100_000).selectExpr("id * 20 AS k", "uuid() AS v", "id AS first", "id AS o")
    seconds = median_of_3(upsert(target, updates, ["k"], ["o"], ["first"]))
    results["upsert_1m_target_100k_updates_rows_per_s"] = round(1_000_000 / seconds)
    print(json.dumps(results))


if __name__ == "__main__":
    main()

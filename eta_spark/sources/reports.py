"""Report sink: one directory per report, written in parallel."""

from pyspark.sql import DataFrame


#: Lines of a compressed CSV file at most: such a file is read by one task.
CSV_LINES = 1 << 20


def write_report(report: DataFrame, directory: str, name: str, fmt: str = "parquet", compression: str | None = None) -> str:
    """``compression`` is for tables of many like lines, such as every order under every scenario; readers need no option."""
    path = f"{directory.rstrip('/')}/{name}"
    writer = report.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", CSV_LINES)
    writer.save(path)
    return path


def write_reports(reports: dict[str, DataFrame], directory: str, fmt: str = "parquet") -> dict[str, str]:
    return {name: write_report(report, directory, name, fmt) for name, report in reports.items()}

"""The usage snippet in README.md runs as written (paths swapped for line
files written from the smallest table)."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from termflow.session import scratch_path
from termflow.sources.corpus import documents_as_lines, write_doc_lines

from conftest import SF001

README = Path(__file__).resolve().parent.parent / "README.md"


def test_readme_snippet_runs(spark):
    code = re.search(r"```python\n(.*?)```", README.read_text(), re.S).group(1)
    lines = documents_as_lines(spark, SF001)
    is_test = F.col("src_id") % 5 == 0
    train, test = scratch_path(spark, "rd-train"), scratch_path(spark, "rd-test")
    write_doc_lines(lines.where(~is_test), train)
    write_doc_lines(lines.where(is_test), test)
    code = code.replace('"s3://bucket/train/"', repr(train)).replace('"s3://bucket/test/"', repr(test))
    code = code.replace(".show()", ".collect()")
    scope = {"spark": spark}
    exec(compile(code, "README.md", "exec"), scope)
    assert scope["size"] > 0 and scope["lr"].numFeatures == 10000

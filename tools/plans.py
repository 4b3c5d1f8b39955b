"""Print the physical operator tree (``explain("formatted")`` header) of catalogue queries.

usage: python tools/plans.py SF_DIR key [key ...]
"""

from __future__ import annotations

import io
import sys
from contextlib import redirect_stdout

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from cohortkit.plans.catalog import QUERIES  # noqa: E402
from cohortkit.session import get_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n\n")[0]


def main() -> None:
    base, keys = sys.argv[1], sys.argv[2:]
    spark = get_session("local[8]", 16, extra={"spark.ui.showConsoleProgress": "false"})
    for k in keys:
        print(f"### {k}\n\n```\n{tree(QUERIES[k](spark, base))}\n```\n")


if __name__ == "__main__":
    main()

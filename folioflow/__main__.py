"""python -m folioflow BOOK STAGE [--pages SPEC]: one stage of a book folder."""

from __future__ import annotations

import argparse
import json

from . import stages
from .session import local_session


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("folder", help="a book's folder; for `list` the folder of all books")
    p.add_argument("stage", choices=["list", "doctor", "audit", "adopt", "verify", "build", "import"])
    p.add_argument("--pages", default="all")
    p.add_argument("--export", help="the file to import")
    p.add_argument("--ignore", action="append", default=[], help="a pattern of text to leave out (adopt)")
    p.add_argument("--require-ready", action="store_true")
    a = p.parse_args(argv)
    spark = local_session()
    run = {
        "list": lambda: stages.library(spark, a.folder),
        "doctor": lambda: stages.doctor(spark, a.folder),
        "audit": lambda: stages.audit(spark, a.folder),
        "adopt": lambda: stages.adopt(spark, a.folder, a.pages, tuple(a.ignore)),
        "verify": lambda: stages.verify(spark, a.folder, a.pages),
        "build": lambda: stages.build(spark, a.folder, a.pages, a.require_ready),
        "import": lambda: stages.import_export(spark, a.folder, a.export),
    }[a.stage]
    try:
        out = run()
    except ValueError as e:
        print(f"refused: {e}")
        return 2
    print(out if isinstance(out, str) else json.dumps(out, ensure_ascii=False, indent=2, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

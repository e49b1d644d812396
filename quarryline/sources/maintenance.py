"""`python -m quarryline.sources.maintenance <store folder> [table ...]`: compaction, expiry and orphans of each table. Exit 1
if any table failed; the others are still done."""

from __future__ import annotations

import sys

from quarryline.sources.store import TableStore, maintain


def main(args: list[str]) -> int:
    from quarryline.session import build_session

    done = maintain(TableStore(build_session("maintenance"), args[0]), args[1:] or None)
    for table, result in done.items():
        print(table, result)
    return int(any("error" in r for r in done.values()))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

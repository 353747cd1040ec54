"""Print the SURVEY §2 operator-ID -> query-key coverage table (markdown) from the registry."""

import os
import re
import sys
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelcast.plans.registry import COVERS, ORACLES  # noqa: E402
import panelcast.plans  # noqa: E402,F401


def main():
    ids = defaultdict(list)
    for k, c in COVERS.items():
        for i in c.split():
            ids[i].append(k + ("" if k in ORACLES else " (rows)"))

    def key(i):
        m = re.match(r"([A-Z]+)(\d+)", i)
        return (m.group(1), int(m.group(2))) if m else (i, 0)

    print("| ID | queries |\n|---|---|")
    for i in sorted(ids, key=key):
        print(f"| {i} | {', '.join(sorted(ids[i]))} |")


if __name__ == "__main__":
    main()

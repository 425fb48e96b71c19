"""Node names and scan facts of a formatted physical plan, for tests."""

import contextlib
import io
import re
from collections import Counter

from pyspark.sql import DataFrame


def plan_facts(df: DataFrame) -> dict:
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain("formatted")
    tree, _, details = printed.getvalue().partition("\n\n")
    # a line of the tree is "+- Name details (number)"; the first word is the node
    nodes = Counter(m[1] for line in tree.splitlines() if (m := re.match(r"[\s:|+*-]*(?:\* )?(\w+).*\(\d+\)$", line)))
    fact = lambda name, shape: re.findall(rf"{name}: {shape}\n", details)
    return {
        "shuffles": nodes["Exchange"],
        "joins": sorted(n for n in nodes.elements() if n.endswith("Join")),
        "pushed": fact("PushedFilters", r"\[(.*?)\]"),
        "read": fact("ReadSchema", r"struct<(.*?)>"),
        "group_limits": nodes["WindowGroupLimit"],
    }

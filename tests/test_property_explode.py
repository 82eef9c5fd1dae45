"""explode_days against a brute-force model of the conversion rules, on random tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sweepframe.functions.daytable import LONG_VALUE_COLUMNS, explode_days

NAMES = ["Day", "Su", "PS/PI", "A/I", "R", "D", "Other"]
WS = st.sampled_from([" ", "  ", "\t", " \t "])


def model(task_id, text):
    """Expected rows, written from the documented rules (not from the engine)."""
    lines = text.split("\n")
    edge = "".join(chr(i) for i in range(0x21))
    header = lines[0].strip(edge).split()  # whitespace runs
    if not header:
        header = [""]
    pos = {}
    for i, h in enumerate(header):
        pos[h.replace("/", "_")] = i  # a repeated name keeps its last position
    day_at = pos.get("Day", 0)
    out = []
    for ln in lines[1:]:
        t = ln.strip(edge)
        if not t:
            continue
        tok = t.split()
        if len(tok) < len(header):
            continue
        vals = tuple(float(tok[pos[c]]) if c in pos else 0.0 for c in LONG_VALUE_COLUMNS)
        out.append((task_id, int(tok[day_at])) + vals)
    return out


@st.composite
def table(draw):
    hdr = draw(st.lists(st.sampled_from(NAMES), min_size=1, max_size=6))
    lines = [draw(WS).join(hdr)]
    for _ in range(draw(st.integers(0, 6))):
        kind = draw(st.sampled_from(["row", "row", "row", "blank", "short", "long"]))
        n = {"row": len(hdr), "blank": 0, "short": max(len(hdr) - 1, 0), "long": len(hdr) + 2}[kind]
        cells = [str(draw(st.integers(0, 500))) for _ in range(n)]
        lines.append(draw(WS) + draw(WS).join(cells) + draw(st.sampled_from(["", " ", "\r"])))
    return "\n".join(lines) + draw(st.sampled_from(["", "\n", "\n\n"]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(table(), min_size=1, max_size=25))
def test_explode_matches_model(spark, tables):
    rows = [(i, 0, 0, t) for i, t in enumerate(tables)]
    df = spark.createDataFrame(rows, "task_id long, params_id long, seed long, output_dat string")
    got = sorted(tuple([r.row_id, r.Day] + [float(r[c]) for c in LONG_VALUE_COLUMNS])
                 for r in explode_days(df).collect())
    want = sorted(x for i, t in enumerate(tables) for x in model(i, t))
    assert got == want

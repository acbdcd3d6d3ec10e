"""Randomised weather files: the Spark reader against a plain-Python model of
the file rules (preamble metadata, header search, separator, header aliases,
row skipping, reading cleanup)."""

from __future__ import annotations

import csv
import io
import math
import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stellata.sources.weather import HEADER_ALIASES, read_weather_hourly

LOGICAL = list(HEADER_ALIASES)


def model_value(text):
    if text is None:
        return None
    s = text.strip().replace(",", ".")
    if s in ("", "-9999", "-9999.0", "null", "NULL", "-"):
        return None
    try:
        v = float(s)
    except ValueError:
        return None
    return None if (math.isnan(v) or math.isinf(v) or v == -9999.0) else v


def model_file(text: str):
    """Hourly rows of one file as (station, date, hour, tmax, tmin, tmed, hum, rain)."""
    lines = text.split("\n")
    lines = [ln[:-1] if ln.endswith("\r") else ln for ln in lines]
    meta = {}
    for ln in lines[:8]:
        s = ln.strip()
        if ";" in s:
            parts = s.split(";")
            meta[parts[0].replace(":", "").strip().upper()] = parts[1].strip() if len(parts) > 1 else ""
    if meta.get("UF", "").strip().upper() != "PR":
        return []
    station = (meta.get("CODIGO (WMO)") or meta.get("CODIGO") or "").strip()
    header_at = next((i for i, ln in enumerate(lines) if i >= 8 and "DATA" in ln.upper()), None)
    if header_at is None:
        return []
    sep = ";" if ";" in lines[header_at] else ","
    rows = list(csv.reader(io.StringIO("\n".join(lines[header_at:])), delimiter=sep))
    norm = [c.strip().upper() for c in rows[0]]
    pos = {}
    for k, aliases in HEADER_ALIASES.items():
        pos[k] = next((norm.index(a.strip().upper()) for a in aliases if a.strip().upper() in norm), None)
    if pos["data"] is None:
        return []
    out = []
    for row in rows[1:]:
        if not row or not row[0].strip():
            continue
        get = lambda k: row[pos[k]] if pos[k] is not None and pos[k] < len(row) else None
        date = (get("data") or "").strip()
        if not date:
            continue
        hour = (get("hora") or "").strip().replace(" UTC", "")
        out.append((station, date, hour) + tuple(model_value(get(k)) for k in
                                                  ("temp_max", "temp_min", "temp_med", "umidade_med",
                                                   "precipitacao")))
    return out


cell = st.one_of(
    st.sampled_from(["", "-9999", "-9999,0", "-9999.00", "null", "NULL", "-", "abc", "NaN"]),
    st.decimals(min_value=-50, max_value=120, places=1, allow_nan=False).map(str),
)


@st.composite
def weather_file(draw):
    sep = draw(st.sampled_from([";", ","]))
    comma_decimals = sep == ";" and draw(st.booleans())
    cols = draw(st.permutations(LOGICAL + ["EXTRA"]))
    names = {k: draw(st.sampled_from(HEADER_ALIASES[k])) for k in LOGICAL}
    drop = draw(st.sampled_from([None, None, "temp_med", "hora", "data"]))
    header_cols = [c for c in cols if c != drop]
    uf = draw(st.sampled_from(["PR", "PR", "PR", "SC", " pr "]))
    pre = ["REGIAO:;S", f"UF:;{uf}", "ESTACAO:;X", f"CODIGO (WMO):;A{draw(st.integers(100, 999))}",
           "LATITUDE:;-25,1", "LONGITUDE:;-49,2", "ALTITUDE:;900", "DATA DE FUNDACAO:;2001-01-01"]
    extra_before = draw(st.integers(0, 2))  # lines between the preamble and the header
    body = []
    for i in range(draw(st.integers(0, 6))):
        if draw(st.integers(0, 9)) == 0:
            body.append("")  # blank line
            continue
        values = []
        for c in header_cols:
            if c == "data":
                values.append(draw(st.sampled_from(["2019-01-01", "2019/01/02", "", " 2019-01-03 "])))
            elif c == "hora":
                values.append(f"{i:02d}00 UTC")
            elif c == "EXTRA":
                values.append("x")
            else:
                v = draw(cell)
                values.append(v.replace(".", ",") if comma_decimals else v)
        buf = io.StringIO()
        csv.writer(buf, delimiter=sep, lineterminator="").writerow(values)
        body.append(buf.getvalue())
    head = io.StringIO()
    csv.writer(head, delimiter=sep, lineterminator="").writerow(
        [names.get(c, "OUTRA COLUNA") for c in header_cols])
    lines = pre + ["obs;sem cabecalho"] * extra_before + [head.getvalue()] + body
    return "\r\n".join(lines) + "\r\n"


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(weather_file(), min_size=1, max_size=4))
def test_reader_matches_model(spark, scratch, files):
    root = os.path.join(tempfile.mkdtemp(dir=scratch), "horarios")
    want = []
    for i, text in enumerate(files):
        os.makedirs(os.path.join(root, "2019"), exist_ok=True)
        with open(os.path.join(root, "2019", f"INMET_S_PR_F{i}.CSV"), "w", encoding="latin-1",
                  newline="") as f:
            f.write(text)
        want += model_file(text)
    got = [(r["codigo_estacao"], r["data"], r["hora_utc"], r["temp_max_c"], r["temp_min_c"],
            r["temp_med_c"], r["umidade_pct"], r["precipitacao_mm"])
           for r in read_weather_hourly(spark, root).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)

"""Synthetic hourly weather folder (ISO-8859-1) covering the reader's cases."""

from __future__ import annotations

import os

PRE = ["REGIAO:;S", "UF:;{uf}", "ESTACAO:;{name}", "CODIGO (WMO):;{code}",
       "LATITUDE:;{lat}", "LONGITUDE:;{lon}", "ALTITUDE:;{alt}", "DATA DE FUNDACAO:;22/05/06"]


def _write(root, rel, lines):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="latin-1", newline="") as f:
        f.write("\r\n".join(lines) + "\r\n")


def _pre(uf="PR", name="CURITIBA", code="A807", lat="-25,44805555", lon="-49,23055555", alt="923,5"):
    return [x.format(uf=uf, name=name, code=code, lat=lat, lon=lon, alt=alt) for x in PRE]


def write_weather_folder(root: str) -> str:
    # 2018, ';' separated, current header spellings, decimal commas, sentinel row
    _write(root, "2018/INMET_S_PR_A807_CURITIBA_01-01-2018_A_31-12-2018.CSV", _pre() + [
        "Data;Hora UTC;PRECIPITAÇÃO TOTAL, HORÁRIO (mm);TEMPERATURA DO AR - BULBO SECO, HORARIA (°C);"
        "TEMPERATURA MÁXIMA NA HORA ANT. (AUT) (°C);TEMPERATURA MÍNIMA NA HORA ANT. (AUT) (°C);"
        "UMIDADE RELATIVA DO AR, HORARIA (%);",
        "2018/01/01;0000 UTC;0;20,5;21,0;19,8;80;",
        "2018/01/01;0100 UTC;1,2;19,5;20,6;19,1;85;",
        "2018/01/01;0200 UTC;-9999;-9999;-9999;-9999;-9999;",
        "2018/01/02;0000 UTC;;18;19;17;null;",
        ";0100 UTC;5;5;5;5;5;",
        "",
    ])
    # 2019, nested folder, lower-case suffix and name part, ',' separated with quoted
    # headers, older spellings, '-9999.00' sentinel and NaN text
    _write(root, "2019/parte1/inmet_s_pr_A807_curitiba.csv", _pre(lat="-25.448", lon="-49.23", alt="923.5") + [
        'DATA (YYYY-MM-DD),HORA (UTC),"PRECIPITACAO TOTAL, HORARIO (mm)",'
        '"TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)",TEMPERATURA MAXIMA NA HORA ANT. (AUT) (°C),'
        'TEMPERATURA MINIMA NA HORA ANT. (AUT) (°C),"UMIDADE RELATIVA DO AR, HORARIA (%)"',
        "2019-01-01,0000,0.2,20.1,21.0,19.0,-9999.00",
        "2019-01-01,0100,0.4,21.1,22.5,20.0,NaN",
        '2019-01-02,0000,"1,5",17.0,18.0,16.0,90',
    ])
    # 2020, short aliases ("Temp. Máx. (°C)"), an all-missing day
    _write(root, "2020/INMET_S_PR_A842_LONDRINA.CSV", _pre(name="LONDRINA", code="A842", lat="-23,3", lon="-51,1", alt="566") + [
        "Data;Hora UTC;Temp. (°C);Temp. Máx. (°C);Temp. Mín. (°C);Umidade (%);Precipitação (mm)",
        "2020-03-01;0000 UTC;-9999;-9999,0;;null;-",
        "2020-03-01;0100 UTC;NULL;-9999.0;-9999;;",
        "2020-03-02;0000 UTC;25,25;26;24;60;0,0",
    ])
    # skipped: UF is not PR although the name says _PR_
    _write(root, "2018/INMET_S_PR_A999_OUTRO.CSV", _pre(uf="SC", code="A999") + [
        "Data;Hora UTC;Temp. (°C)", "2018-01-01;0000 UTC;10"])
    # skipped: header has DATA only inside another name (no date column)
    _write(root, "2018/INMET_S_PR_B000_SEMDATA.CSV", _pre(code="B000") + [
        "DATAHORA;Temp. (°C)", "2018-01-01 00:00;10"])
    # skipped: no _PR_ in the name
    _write(root, "2018/INMET_SE_SP_A701_SAO_PAULO.CSV", _pre(uf="SP", code="A701") + [
        "Data;Hora UTC;Temp. (°C)", "2018-01-01;0000 UTC;10"])
    # skipped: year folder outside 2018-2023
    _write(root, "2017/INMET_S_PR_A807_CURITIBA.CSV", _pre() + [
        "Data;Hora UTC;Temp. (°C)", "2017-01-01;0000 UTC;10"])
    return root

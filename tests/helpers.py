import datetime as dt


NAV_TYPE = "scheme_code string, scheme_name string, fund_house string, date date, nav double"


def day(i: int) -> dt.date:
    return dt.date(2020, 1, 1) + dt.timedelta(days=i)


def nav_frame(spark, series: dict[str, list[float | None]], house: str = "H", start: int = 0):
    rows = []
    for code, values in series.items():
        for i, v in enumerate(values):
            rows.append((code, f"name {code}", house, day(start + i), None if v is None else float(v)))
    return spark.createDataFrame(rows, NAV_TYPE)


def collect_dict(df, key="scheme_code"):
    return {r[key]: r.asDict() for r in df.collect()}

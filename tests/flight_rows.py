"""Rows and files of raw flights for the tests, and the folder of the sample tables."""

SAMPLE = "/root/testdata/sf0.001"

RAW_HEADER = [
    "FlightDate", "IATA_CODE_Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin",
    "Dest", "CRSDepTime", "DepTime", "DepDelay", "CRSArrTime", "ArrTime", "ArrDelay", "Cancelled",
    "CancellationCode", "Diverted", "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Distance",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay", "Year",
    "Month", "DayofMonth", "DayOfWeek",
]


def raw_row(**changes):
    row = dict(zip(RAW_HEADER, [
        "2023-01-15", "AA", "0100", "JFK", "LAX", "0800", "0815", "15.00", "1100", "1120", "20.00",
        "0.00", "", "0.00", "180.00", "185.00", "160.00", "2475.00", "20.00", "0.00", "0.00",
        "0.00", "0.00", "2023", "1", "15", "7",
    ]))
    row.update(changes)
    return row


def write_csv(path, rows, header=None):
    """A file as delivered: quoted values, and a blank last column."""
    header = header or RAW_HEADER
    lines = [",".join([f'"{h}"' for h in header] + [""])]
    lines += [",".join([f'"{r[h]}"' if r[h] != "" else "" for h in header] + [""]) for r in rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)

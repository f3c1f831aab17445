"""Column functions that write numbers and labels for people."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SMALL = "ᴀʙᴄᴅᴇꜰɢʜɪᴊᴋʟᴍɴᴏᴘǫʀꜱᴛᴜᴠᴡxʏᴢ"


def half_up(x: Column, digits: int = 0) -> Column:
    """Rounds halves towards plus infinity, also below zero."""
    return F.floor(x * 10**digits + 0.5) / 10**digits


def format_bytes(n: Column, k: int = 1000, rounded: bool = False) -> Column:
    """Size with two decimals, or ``rounded`` to none, and the largest unit below it; 0 is ``0 B``."""
    units = ["B", "KB", "MB", "GB", "TB", "PB"] if k == 1000 else ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]
    value, unit = n.cast("double"), F.lit(units[0])
    for i, u in reversed(list(enumerate(units))[1:]):
        value = F.when(n >= float(k) ** i, n / float(k) ** i).otherwise(value) if i == len(units) - 1 else F.when((n >= float(k) ** i) & (n < float(k) ** (i + 1)), n / float(k) ** i).otherwise(value)
    for i, u in enumerate(units[1:], 1):
        unit = F.when(n >= float(k) ** i, u).otherwise(unit)
    shown = half_up(half_up(value, 2)) if rounded else half_up(value, 2)
    text = F.regexp_replace(F.regexp_replace(F.format_string("%.2f", shown), r"0+$", ""), r"\.$", "")
    return F.concat(text, F.lit(" "), unit)


def _smart(n: Column, k: int, units: list[str], zero: str) -> Column:
    """Three figures: no decimals from 100 on, one from 10 on (none if it is 0), else two without trailing zeros."""
    power: Column = F.lit(0)
    for i in range(1, len(units)):
        power = F.when(n >= float(k) ** i, i).otherwise(power)
    raw = n / F.pow(F.lit(float(k)), power)
    short = lambda digits: F.regexp_replace(F.regexp_replace(F.format_string(f"%.{digits}f", half_up(raw, digits)), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    text = F.when(raw >= 100, F.format_string("%.0f", half_up(raw))).when(raw >= 10, short(1)).otherwise(short(2))
    return F.when(n <= 0, zero).otherwise(F.concat(text, F.lit(" "), F.element_at(F.array(*[F.lit(u) for u in units]), power + 1)))


def smart_bytes(n: Column, k: int = 1000) -> Column:
    """Size in three figures."""
    return _smart(n.cast("double"), k, ["B", "KB", "MB", "GB", "TB"] if k == 1000 else ["B", "KiB", "MiB", "GiB", "TiB"], "0 B")


def smart_bitrate(n: Column) -> Column:
    """Bitrate in three figures; ``0 bps`` where it is not known."""
    return _smart(F.coalesce(n.cast("double"), F.lit(0.0)), 1000, ["bps", "Kbps", "Mbps", "Gbps", "Tbps"], "0 bps")


def format_duration(ms: Column) -> Column:
    """``1h:2m:3s``; below an hour ``2m:3s``, or ``2m`` for whole minutes."""
    s = F.floor(ms / 1000)
    h, m, r = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), (s % 60).cast("long")
    return F.when(h > 0, F.format_string("%dh:%dm:%ds", h, m, r)).when(r > 0, F.format_string("%dm:%ds", m, r)).otherwise(F.format_string("%dm", m))


def format_hours(hours: Column) -> Column:
    """Days and hours, or hours alone below a day."""
    d, h = F.floor(hours / 24).cast("long"), (hours % 24).cast("long")
    return F.when(d > 0, F.format_string("%dd", d)).otherwise(F.format_string("%dh", h))


def small_caps(text: Column) -> Column:
    return F.translate(F.lower(text), "abcdefghijklmnopqrstuvwxyz", SMALL)


def season_label(seasons: Column, prefix: str = "S") -> Column:
    """``S01-03`` for a list, ``S01`` for one; null for none."""
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    low, high = F.array_min(seasons), F.array_max(seasons)
    return F.when(F.size(seasons) > 0, F.concat(F.lit(prefix), two(low), F.when(high > low, F.concat(F.lit("-"), two(high))).otherwise(F.lit(""))))


#: Bins of sizes below 5 GiB (fixed values): bounds in MiB, label.
SIZE_BINS = ((0, 100, "0-100MB"), (100, 300, "100-300MB"), (300, 500, "300-500MB"), (500, 1024, "500MB-1GB"), (1024, 2048, "1-2GB"), (2048, 3072, "2-3GB"), (3072, 4096, "3-4GB"), (4096, 5120, "4-5GB"))


def size_bin(n: Column) -> Column:
    """Label of a size in bytes: fixed bins below 5 GiB, then whole GiB at powers of 1.5; null for 0 and null.

    A size on the border of two fixed bins lies in neither and has ``5GB+``.
    """
    mib, gib = n / 2**20, n / 2**30
    small = F.coalesce(*[F.when((mib < high) & ((mib > low) if low else F.lit(True)), F.lit(label)) for low, high, label in SIZE_BINS], F.lit("5GB+"))
    step = F.floor(F.log(gib) / F.log(F.lit(1.5)))
    low, high = (F.floor(F.pow(F.lit(1.5), step + k)).cast("string") for k in (0, 1))
    large = F.when(low == high, F.concat(high, F.lit("GB+"))).otherwise(F.concat(low, F.lit("-"), high, F.lit("GB")))
    return F.when(F.coalesce(n, F.lit(0)) != 0, F.when(gib < 5, small).otherwise(large))

"""Times and directions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col

#: Fixed value: geographic longitude (degrees) for sidereal time where none is given.
LONGITUDE = -118.281667
#: Fixed value: speed of light, m/s.
C_M_S = 299792458.0


def julian_date(ts: Column | str) -> Column:
    """Julian date of a UTC time, from the calendar by integer arithmetic."""
    ts = col(ts)
    a = F.floor((14 - F.month(ts)) / F.lit(12.0))
    y, m = F.year(ts) + 4800 - a, F.month(ts) + 12 * a - 3
    number = F.dayofmonth(ts) + F.floor((153 * m + 2) / F.lit(5.0)) + 365 * y + F.floor(y / F.lit(4.0)) - F.floor(y / F.lit(100.0)) + F.floor(y / F.lit(400.0)) - 32045
    return number + (F.hour(ts) - 12) / F.lit(24.0) + F.minute(ts) / F.lit(1440.0) + F.extract(F.lit("SECOND"), ts).cast("double") / 86400.0


def utc_of_julian(jd: Column | str) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of a Julian date, rounded to the second."""
    seconds = F.rint((col(jd) - 2440587.5) * 86400.0).cast("bigint")
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")


def sidereal_hours(jd: Column | str, longitude: float = LONGITUDE) -> Column:
    """Local mean sidereal time in hours."""
    gmst = 18.697374558 + 24.06570982441908 * (col(jd) - 2451545.0)
    return F.pmod(gmst + longitude * 24.0 / 360.0, F.lit(24.0))


def separation(dec1: Column | str, ra1: Column | str, dec2: Column | str, ra2: Column | str) -> Column:
    """Great-circle distance in degrees, by Vincenty's formula."""
    p, q, d = F.radians(col(dec1)), F.radians(col(dec2)), F.radians(F.abs(col(ra2) - col(ra1)))
    across = F.sqrt(F.pow(F.cos(q) * F.sin(d), 2.0) + F.pow(F.cos(p) * F.sin(q) - F.sin(p) * F.cos(q) * F.cos(d), 2.0))
    return F.degrees(F.atan2(across, F.sin(p) * F.sin(q) + F.cos(p) * F.cos(q) * F.cos(d)))


def elevation(ra: Column | str, dec: Column | str, zenith_ra: Column | str, zenith_dec: Column | str) -> Column:
    """Elevation in degrees of a direction, the zenith being (sidereal time, latitude) in degrees."""
    h, d, z = F.radians(col(ra) - col(zenith_ra)), F.radians(col(dec)), F.radians(col(zenith_dec))
    return F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.sin(d) * F.sin(z) + F.cos(d) * F.cos(z) * F.cos(h)))))


def azimuth(ra: Column | str, dec: Column | str, zenith_ra: Column | str, zenith_dec: Column | str) -> Column:
    """Azimuth in degrees, from north by east, in [0, 360)."""
    h, d, z = F.radians(col(zenith_ra) - col(ra)), F.radians(col(dec)), F.radians(col(zenith_dec))
    return F.pmod(F.degrees(F.atan2(-F.cos(d) * F.sin(h), F.sin(d) * F.cos(z) - F.cos(d) * F.sin(z) * F.cos(h))), F.lit(360.0))


def power_law(flux: Column | str, index: Column | str, f: Column | float, f0: float, beam: Column | float = 1.0) -> Column:
    """Flux at frequency f of a power law given at f0, times a beam factor."""
    return col(flux) * F.pow(F.lit(10.0), col(index) * F.log10(F.lit(f) / F.lit(f0) if not isinstance(f, Column) else f / F.lit(f0))) * beam


def direction_cosines(ra: Column, dec: Column, ra0: Column, dec0: Column) -> tuple[Column, Column, Column]:
    """(l, m, n - 1) of a direction seen from the phase centre; degrees."""
    d, d0, dr = F.radians(dec), F.radians(dec0), F.radians(ra - ra0)
    n = F.sin(d) * F.sin(d0) + F.cos(d) * F.cos(d0) * F.cos(dr)
    return F.cos(d) * F.sin(dr), F.sin(d) * F.cos(d0) - F.cos(d) * F.sin(d0) * F.cos(dr), n - 1


def sky_to_pixel(ra: Column | str, dec: Column | str, ra0: float, dec0: float, scale: float, centre: float) -> tuple[Column, Column]:
    """(x, y), counted from 0, on a SIN plane of ``scale`` degrees a pixel with its reference at pixel ``centre`` (from 1);
    null below the horizon. x grows to smaller right ascensions."""
    h, d = F.radians(col(ra) - ra0), F.radians(col(dec))
    d0 = F.radians(F.lit(dec0))
    up = F.sin(d) * F.sin(d0) + F.cos(d) * F.cos(d0) * F.cos(h)
    east, north = F.degrees(F.cos(d) * F.sin(h)), F.degrees(F.sin(d) * F.cos(d0) - F.cos(d) * F.sin(d0) * F.cos(h))
    return F.when(up > 0, -east / scale + (centre - 1)), F.when(up > 0, north / scale + (centre - 1))


def pixel_to_sky(x: Column | str, y: Column | str, ra0: float, dec0: float, scale: float, centre: float) -> tuple[Column, Column]:
    """(ra, dec) in degrees of a pixel of a SIN plane; null outside the hemisphere."""
    east, north = F.radians(-(col(x) - (centre - 1)) * scale), F.radians((col(y) - (centre - 1)) * scale)
    left = 1 - east * east - north * north
    up, d0 = F.sqrt(F.greatest(left, F.lit(0.0))), F.radians(F.lit(dec0))
    dec = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), up * F.sin(d0) + north * F.cos(d0))))
    ra = ra0 + F.degrees(F.atan2(east, up * F.cos(d0) - north * F.sin(d0)))
    return F.when(left >= 0, F.pmod(ra, F.lit(360.0))), F.when(left >= 0, F.degrees(dec))


def beam_gain(el: Column | str, power: float = 1.6) -> Column:
    """Analytic primary beam sin(el)**1.6; null below the horizon."""
    return F.when(col(el) > 0, F.pow(F.sin(F.radians(col(el))), F.lit(power)))


def gaussian(x: Column, y: Column, amp: float, x0: float, y0: float, fwhm_x: float, fwhm_y: float, angle_deg: float, offset: float = 0.0) -> Column:
    """Value of a rotated two-dimensional Gaussian; a zero width counts as a sigma of 1."""
    from math import cos, radians, sin

    sx, sy, t = fwhm_x / 2.35482 or 1.0, fwhm_y / 2.35482 or 1.0, radians(angle_deg)
    a = cos(t) ** 2 / (2 * sx**2) + sin(t) ** 2 / (2 * sy**2)
    b = sin(2 * t) / (4 * sy**2) - sin(2 * t) / (4 * sx**2)
    c = sin(t) ** 2 / (2 * sx**2) + cos(t) ** 2 / (2 * sy**2)
    return offset + amp * F.exp(-(a * (x - x0) * (x - x0) + 2 * b * (x - x0) * (y - y0) + c * (y - y0) * (y - y0)))


def in_ellipse(x: Column, y: Column, x0: float, y0: float, half_x: float, half_y: float, angle_deg: float) -> Column:
    """Value of a rotated ellipse's equation: at most 1 inside."""
    from math import cos, radians, sin

    t = radians(angle_deg)
    along, across = (x - x0) * cos(t) + (y - y0) * sin(t), (y - y0) * cos(t) - (x - x0) * sin(t)
    return along * along / half_x**2 + across * across / half_y**2


def parse_scan_name(name: Column | str) -> Column:
    """UTC time of ``yyyyMMdd_HHmmss_...``; null for other names."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(col(name), r"^(\d{8}_\d{6})_", 1), F.lit("")), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")


def frequency_tag(name: Column | str) -> Column:
    """The number before MHz in a path; null if there is none."""
    return F.nullif(F.regexp_extract(col(name), r"(\d+)MHz", 1), F.lit("")).cast("int")


def sexagesimal(value: Column | str, signed: bool = True) -> Column:
    """'+DD:MM:SS.ss' of a number of degrees or hours."""
    value = col(value)
    hundredths = F.rint(F.abs(value) * 360000.0).cast("bigint")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit("+" if signed else ""))
    part = lambda d, m: F.lpad((F.floor(hundredths / F.lit(float(d))).cast("bigint") % m).cast("string"), 2, "0")
    degrees = F.floor(hundredths / F.lit(360000.0)).cast("bigint").cast("string")
    return F.concat(sign, F.when(F.length(degrees) < 2, F.lpad(degrees, 2, "0")).otherwise(degrees), F.lit(":"), part(6000, 60), F.lit(":"), part(100, 60), F.lit("."), F.lpad((hundredths % 100).cast("string"), 2, "0"))


def parse_sexagesimal(text: Column | str) -> Column:
    """Number of degrees or hours of 'D:M:S', with an optional sign."""
    parts = F.split(F.regexp_replace(col(text), "^[+-]", ""), ":")
    value = F.get(parts, F.lit(0)).cast("double") + F.coalesce(F.get(parts, F.lit(1)).cast("double"), F.lit(0.0)) / 60.0 + F.coalesce(F.get(parts, F.lit(2)).cast("double"), F.lit(0.0)) / 3600.0
    return F.when(F.startswith(col(text), F.lit("-")), -value).otherwise(value)


def hours_minutes(hours: Column | str) -> Column:
    """'HH:MM' of hours, rounded to the minute; 24:00 is 00:00."""
    minutes = F.rint(col(hours) * 60.0).cast("bigint") % 1440
    return F.concat(F.lpad(F.floor(minutes / F.lit(60.0)).cast("string"), 2, "0"), F.lit(":"), F.lpad((minutes % 60).cast("string"), 2, "0"))

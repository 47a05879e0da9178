"""Pose, camera and map-projection transforms as Column arithmetic (no Python in the data path).

A 3x4 transform is a list of 12 Columns or floats, row-major.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

M12 = Sequence


def col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def planar(x: Column, y: Column, px: Column, py: Column, yaw: Column) -> tuple[Column, Column]:
    c, s = F.cos(yaw), F.sin(yaw)
    return c * x - s * y + px, s * x + c * y + py


def pose_matrix(x, y, z, roll, pitch, yaw) -> list[Column]:
    """Rz(yaw) Ry(pitch) Rx(roll) with translation."""
    c1, s1, c2, s2, c3, s3 = F.cos(yaw), F.sin(yaw), F.cos(pitch), F.sin(pitch), F.cos(roll), F.sin(roll)
    return [c1 * c2, c1 * s2 * s3 - s1 * c3, c1 * s2 * c3 + s1 * s3, x,
            s1 * c2, s1 * s2 * s3 + c1 * c3, s1 * s2 * c3 - c1 * s3, y,
            -s2, c2 * s3, c2 * c3, z]


def apply(m: M12, x: Column, y: Column, z: Column) -> list[Column]:
    return [col(m[4 * i]) * x + col(m[4 * i + 1]) * y + col(m[4 * i + 2]) * z + col(m[4 * i + 3]) for i in range(3)]


def rotate(m: M12, x: Column, y: Column, z: Column) -> list[Column]:
    return [col(m[4 * i]) * x + col(m[4 * i + 1]) * y + col(m[4 * i + 2]) * z for i in range(3)]


def inverse_rigid(m: M12) -> list[Column]:
    """Inverse of a rotation + translation: transpose and rotated negative offset."""
    r = [[col(m[4 * i + j]) for j in range(3)] for i in range(3)]
    t = [col(m[4 * i + 3]) for i in range(3)]
    out: list[Column] = []
    for i in range(3):
        out += [r[0][i], r[1][i], r[2][i], -(r[0][i] * t[0] + r[1][i] * t[1] + r[2][i] * t[2])]
    return out


def compose(a: M12, b: M12) -> list[Column]:
    """a after b."""
    out: list[Column] = []
    for i in range(3):
        for j in range(4):
            v = sum((col(a[4 * i + k]) * col(b[4 * k + j]) for k in range(1, 3)), col(a[4 * i]) * col(b[j]))
            out.append(v + col(a[4 * i + 3]) if j == 3 else v)
    return out


def similarity(x: Column, y: Column, z: Column, dx: float, dy: float, dz: float, yaw_deg: float, scale: float):
    c, s = math.cos(math.radians(yaw_deg)), math.sin(math.radians(yaw_deg))
    return scale * (c * x - s * y) + dx, scale * (s * x + c * y) + dy, z + dz


# WGS84 ellipsoid and UTM zone 32 (fixed values)
_A, _F, _K0, _LON0, _FE = 6378137.0, 1 / 298.257223563, 0.9996, 9.0, 500000.0
_N = _F / (2 - _F)
_R = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def to_utm32(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Krueger series, third order: sub-millimetre inside the zone."""
    e = 2 * math.sqrt(_N) / (1 + _N)
    phi, lam = F.radians(lat), F.radians(lon - _LON0)
    atanh = lambda v: 0.5 * F.log((1 + v) / (1 - v))
    t = F.sinh(atanh(F.sin(phi)) - e * atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), atanh(F.sin(lam) / F.sqrt(1 + t * t))
    e_sum, n_sum = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        e_sum = e_sum + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        n_sum = n_sum + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return _FE + _K0 * _R * e_sum, _K0 * _R * n_sum


def from_utm32(east: Column, north: Column) -> tuple[Column, Column]:
    xi, eta = north / (_K0 * _R), (east - _FE) / (_K0 * _R)
    x, h = xi, eta
    for j, b in enumerate(_BETA, 1):
        x = x - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        h = h - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(x) / F.cosh(h))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.degrees(lat), _LON0 + F.degrees(F.atan2(F.sinh(h), F.cos(x)))


def project_rect(p: M12, x: Column, y: Column, z: Column, min_depth: float = 1e-6):
    """Pixel by a 3x4 projection: (u, v, depth, valid); u and v are NULL behind the camera."""
    a, b, w = apply(p, x, y, z)
    ok = w > min_depth
    return F.when(ok, a / w), F.when(ok, b / w), w, ok


def project_k(fx: float, fy: float, cx: float, cy: float, x: Column, y: Column, z: Column, y_flip: bool = True, min_depth: float = 1e-6):
    """Pixel by pinhole parameters; ``y_flip`` mirrors the vertical axis."""
    ok = z > min_depth
    v = fy * y / z
    return F.when(ok, fx * x / z + cx), F.when(ok, (cy - v) if y_flip else (v + cy)), z, ok


def in_image(u: Column, v: Column, ok: Column, width: float, height: float) -> Column:
    return F.coalesce(ok & (u >= 0) & (u < width) & (v >= 0) & (v < height), F.lit(False))


def pixel_ray(fx: float, fy: float, cx: float, cy: float, u: Column, v: Column) -> list[Column]:
    return [(u - cx) / fx, (v - cy) / fy, F.lit(1.0)]


def ray_to_plane(origin: Sequence[Column], ray: Sequence[Column], z0: float | Column = 0.0) -> tuple[Column, Column, Column]:
    """Hit of a downward ray with the plane z = z0: (x, y, t); NULL when it never comes down to it."""
    t = F.when(ray[2] < -1e-6, (col(z0) - origin[2]) / ray[2])
    t = F.when(t > 0, t)
    return origin[0] + t * ray[0], origin[1] + t * ray[1], t


def uint16_intensity(v: Column, frame_max: Column) -> tuple[Column, Column]:
    """Float intensity to 0..65535: frames whose maximum is <= 1.5 are unit scaled."""
    unit = frame_max <= 1.5
    raw = F.when(unit, v * 65535.0).otherwise(v)
    val = F.bround(F.least(F.greatest(raw, F.lit(0.0)), F.lit(65535.0)), 0).cast("int")
    return val, F.when(unit, "float_x65535").otherwise("float_clipped")


def quantise(v: Column, offset: float, scale: float = 0.001) -> Column:
    return F.bround((v - offset) / scale, 0).cast("long")

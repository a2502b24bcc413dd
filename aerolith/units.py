"""Conversion factors and the three earth radii, which are not interchangeable."""

M_TO_FT = 3.28084
MS_TO_FTMIN = 196.850394
MS_TO_KT = 1.94384
KM_PER_NM = 1.852
NM_PER_M = 0.000539957
#: Track distances and the ranking of aerodromes, km.
EARTH_KM = 6371.0
#: Candidate distances and destination points, NM.
EARTH_NM = 3440.065
#: Ring polygons, km.
EARTH_RING_KM = 6371.01

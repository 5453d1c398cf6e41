"""Fixed parameters for queries that apply a model without fitting one, so that SQL can too."""

from __future__ import annotations

#: Registers the parameters are for.
COLUMNS = ("BITQ_V-t_ALL", "BITP_V-t_ALL", "BITD_V_ALL")
#: Sets of centres, one for each k.
CENTRE_SETS = (
    ((7.13, 11.7, 2.9), (31.3, 53.9, 6.1)),
    ((4.17, 9.3, 1.7), (19.9, 37.1, 4.3), (43.7, 71.3, 8.9)),
    ((3.11, 8.9, 1.3), (12.7, 51.1, 3.7), (29.3, 23.3, 6.7), (41.9, 79.7, 7.9), (22.1, 5.3, 9.1)),
)
#: Gaussian mixtures: weights, means, covariances.
MIXTURES = (
    ((1.0,), ((24.37, 43.19, 4.73),), (((211.0, 13.0, 1.5), (13.0, 613.0, 2.5), (1.5, 2.5, 8.3)),)),
    (
        (0.37, 0.34, 0.29),
        ((8.37, 14.19, 3.41), (23.71, 61.37, 5.19), (41.13, 38.83, 4.67)),
        (
            ((31.0, 4.1, 0.7), (4.1, 97.0, 1.1), (0.7, 1.1, 7.9)),
            ((83.0, -9.3, 1.3), (-9.3, 401.0, -2.1), (1.3, -2.1, 9.7)),
            ((47.0, 11.9, -0.9), (11.9, 307.0, 3.3), (-0.9, 3.3, 6.1)),
        ),
    ),
)
#: Divisions: the centres of two parts, each a label or divided again.
TREE = (
    (13.1, 27.7, 3.3),
    ((6.1, 9.7, 2.3), 0, (17.9, 41.3, 5.7), 1),
    (37.3, 59.9, 6.9),
    ((29.9, 77.1, 4.1), 2, (43.1, 33.7, 7.3), ((41.9, 19.1, 6.1), 3, (45.7, 51.7, 8.3), 4)),
)
#: Components: means, loadings and the spreads their scores are divided by.
MEANS = (23.9, 44.3, 4.7)
LOADINGS = ((0.36, 0.93, 0.08), (0.93, -0.36, 0.02))
SPREADS = (24.7, 13.9)
#: A forest: trees of (register, threshold, part at most the threshold, part above), leaves 0 or 1.
FOREST = (
    ("BITQ_V-t_ALL", 30.5, 0, ("BITD_V_ALL", 4.5, 0, 1)),
    ("BITP_V-t_ALL", 55.25, ("BITQ_V-t_ALL", 41.5, 0, 1), 1),
    ("BITD_V_ALL", 6.5, ("BITP_V-t_ALL", 70.25, 0, 1), ("BITQ_V-t_ALL", 12.5, 0, 1)),
)

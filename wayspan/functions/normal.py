"""Standard normal distribution as Spark columns (stays inside codegen).

The distribution function uses the W. J. Cody (1969) rational approximations of erf/erfc and
its inverse the M. J. Wichura (1988, AS 241) ones; both are good to about 1e-15.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Published coefficients, lowest power first.
AS241_CENTRE_NUM = [3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
                    45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727]
AS241_CENTRE_DEN = [1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
                    21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610]
AS241_MIDDLE_NUM = [1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
                    1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4]
AS241_MIDDLE_DEN = [1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
                    0.148103976427480074590, 0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9]
AS241_TAIL_NUM = [6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
                  0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7]
AS241_TAIL_DEN = [1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
                  7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15]
CODY_ERF_NUM = [3209.37758913846947, 377.485237685302021, 113.864154151050156, 3.16112374387056560, 0.185777706184603153]
CODY_ERF_DEN = [2844.23683343917062, 1282.61652607737228, 244.024637934444173, 23.6012909523441209, 1.0]
CODY_ERFC_NUM = [1230.33935479799725, 2051.07837782607147, 1712.04761263407058, 881.952221241769090,
                 298.635138197400131, 66.1191906371416295, 8.88314979438837594, 0.564188496988670089, 2.15311535474403846e-8]
CODY_ERFC_DEN = [1230.33935480374942, 3439.36767414372164, 4362.61909014324716, 3290.79923573345963,
                 1621.38957456669019, 537.181101862009858, 117.693950891312499, 15.7449261107098347, 1.0]
CODY_FAR_NUM = [-6.58749161529837803e-4, -0.0160837851487422766, -0.125781726111229246,
                -0.360344899949804439, -0.305326634961232344, -0.0163153871373020978]
CODY_FAR_DEN = [2.33520497626869185e-3, 0.0605183413124413191, 0.527905102951428412,
                1.87295284992346047, 2.56852019228982242, 1.0]
INV_SQRT_PI = 0.56418958354775628695
SQRT_HALF = 0.70710678118654752440
LOG_SQRT_2PI = 0.91893853320467274178


def _poly(x: Column, coefs: Sequence[float]) -> Column:
    out = F.lit(coefs[-1])
    for c in reversed(coefs[:-1]):
        out = out * x + F.lit(c)
    return out


def _ratio(x: Column, num: Sequence[float], den: Sequence[float]) -> Column:
    return _poly(x, num) / _poly(x, den)


# The pieces of each formula are separate columns: a polynomial repeats its argument many
# times, and a column is computed once per row while a nested expression is not.

def add_quantile(df: DataFrame, p: Column, out: str) -> DataFrame:
    """Add the inverse of the normal distribution function; NULL outside (0, 1)."""
    df = df.withColumn("_p", p)
    df = df.withColumns({"_q": F.col("_p") - F.lit(0.5), "_r": F.sqrt(-F.log(F.least("_p", F.lit(1.0) - F.col("_p"))))})
    q = F.col("_q")
    df = df.withColumns({"_c": F.lit(0.180625) - q * q, "_m": F.col("_r") - F.lit(1.6), "_t": F.col("_r") - F.lit(5.0)})
    centre = q * _ratio(F.col("_c"), AS241_CENTRE_NUM, AS241_CENTRE_DEN)
    middle = _ratio(F.col("_m"), AS241_MIDDLE_NUM, AS241_MIDDLE_DEN)
    tail = _ratio(F.col("_t"), AS241_TAIL_NUM, AS241_TAIL_DEN)
    outer = F.when(F.col("_r") <= 5.0, middle).otherwise(tail)
    value = F.when(F.abs(q) <= 0.425, centre).otherwise(F.signum(q) * outer)
    inside = (F.col("_p") > 0) & (F.col("_p") < 1)
    return df.withColumn(out, F.when(inside, value)).drop("_p", "_q", "_r", "_c", "_m", "_t")


def add_cdf(df: DataFrame, x: Column, out: str) -> DataFrame:
    """Add the normal distribution function."""
    df = df.withColumn("_z", x * F.lit(SQRT_HALF)).withColumn("_y", F.abs("_z"))
    y, z = F.col("_y"), F.col("_z")
    df = df.withColumns({"_s": z * z, "_i": F.lit(1.0) / F.nullif(z * z, F.lit(0.0)), "_e": F.exp(-z * z)})
    core = z * _ratio(F.col("_s"), CODY_ERF_NUM, CODY_ERF_DEN)
    near = F.col("_e") * _ratio(y, CODY_ERFC_NUM, CODY_ERFC_DEN)
    inv = F.col("_i")
    far = F.col("_e") / F.nullif(y, F.lit(0.0)) * (F.lit(INV_SQRT_PI) + inv * _ratio(inv, CODY_FAR_NUM, CODY_FAR_DEN))
    df = df.withColumn("_u", F.lit(0.5) * F.when(y <= 4.0, near).otherwise(far))
    value = F.when(y < 0.46875, F.lit(0.5) * (F.lit(1.0) + core)).when(z < 0, F.col("_u")).otherwise(F.lit(1.0) - F.col("_u"))
    return df.withColumn(out, value).drop("_z", "_y", "_s", "_i", "_e", "_u")


def add_log_cdf(df: DataFrame, x: Column, out: str) -> DataFrame:
    """Add the logarithm of the distribution function; far in the lower tail by its asymptotic series."""
    df = add_cdf(df.withColumn("_x", x), F.greatest(F.col("_x"), F.lit(-30.0)), "_cdf")
    v = F.col("_x")
    df = df.withColumn("_iv", F.lit(1.0) / F.nullif(v * v, F.lit(0.0)))
    inv = F.col("_iv")
    far = -v * v / 2.0 - F.log(-v) - F.lit(LOG_SQRT_2PI) + F.log1p(-inv * (1.0 - inv * (3.0 - inv * 15.0)))
    return df.withColumn(out, F.when(v < -30.0, far).otherwise(F.log("_cdf"))).drop("_x", "_cdf", "_iv")

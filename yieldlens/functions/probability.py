"""Normal, Student-t (5 degrees of freedom) and chi-squared functions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Coefficients of Wichura (1988), algorithm AS 241, constant term first.
NORMAL_CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
NORMAL_TAIL = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
NORMAL_FAR_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)

# Coefficients of Cody (1969) for erf and erfc, constant term first.
ERF_NEAR = (
    (3.20937758913846947e3, 3.77485237685302021e2, 1.13864154151050156e2, 3.16112374387056560e0,
     1.85777706184603153e-1),
    (2.84423683343917062e3, 1.28261652607737228e3, 2.44024637934444173e2, 2.36012909523441209e1, 1.0),
)
ERFC_MIDDLE = (
    (1.23033935479799725e3, 2.05107837782607147e3, 1.71204761263407058e3, 8.81952221241769090e2,
     2.98635138197400131e2, 6.61191906371416295e1, 8.88314979438837594e0, 5.64188496988670089e-1,
     2.15311535474403846e-8),
    (1.23033935480374942e3, 3.43936767414372164e3, 4.36261909014324716e3, 3.29079923573345963e3,
     1.62138957456669019e3, 5.37181101862009858e2, 1.17693950891312499e2, 1.57449261107098347e1, 1.0),
)
ERFC_FAR = (
    (6.58749161529837803e-4, 1.60837851487422766e-2, 1.25781726111229246e-1, 3.60344899949804439e-1,
     3.05326634961232344e-1, 1.63153871373020978e-2),
    (2.33520497626869185e-3, 6.05183413124413191e-2, 5.27905102951428412e-1, 1.87295284992346725e0,
     2.56852019228982242e0, 1.0),
)


def _polynomial(x: Column, coefficients) -> Column:
    value = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        value = value * x + F.lit(c)
    return value


def _ratio(x: Column, pair) -> Column:
    return _polynomial(x, pair[0]) / _polynomial(x, pair[1])


def normal_upper_quantile(p: Column) -> Column:
    """z with P(Z > z) = p for 0 < p <= 1/2, at full double precision; null outside."""
    q = F.lit(0.5) - p
    r = F.sqrt(-F.ln(p))
    return (
        F.when((p <= 0) | (p > 0.5), F.lit(None).cast("double"))
        .when(q <= 0.425, q * _ratio(F.lit(0.180625) - q * q, NORMAL_CENTRE))
        .when(r <= 5.0, _ratio(r - 1.6, NORMAL_TAIL))
        .otherwise(_ratio(r - 5.0, NORMAL_FAR_TAIL))
    )


def normal_quantile(p: Column) -> Column:
    return F.when(p <= 0.5, -normal_upper_quantile(p)).otherwise(normal_upper_quantile(F.lit(1.0) - p))


def t5_upper_tail(t: Column) -> Column:
    """P(T > |t|) for Student's t with 5 degrees of freedom.

    With phi = atan(sqrt 5 / |t|) the tail is 8/(3 pi) times the integral of sin^4
    from 0 to phi; near zero its power series avoids the cancellation of the closed form.
    """
    phi = F.atan2(F.lit(math.sqrt(5.0)), F.abs(t))
    s, c = F.sin(phi), F.cos(phi)
    closed = (phi - s * c * (1.0 + 2.0 / 3.0 * s * s)) / math.pi
    terms = [
        (-1) ** n * (16.0**n - 4.0 * 4.0**n) / (8.0 * math.factorial(2 * n) * (2 * n + 1)) for n in range(2, 13)
    ]
    square = phi * phi
    series = square * square * phi * _polynomial(square, terms) * (8.0 / (3.0 * math.pi))
    return F.when(phi < 0.5, series).otherwise(closed)


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0."""
    square = x * x
    inverse = F.lit(1.0) / F.nullif(square, F.lit(0.0))
    near = 1.0 - x * _ratio(square, ERF_NEAR)
    middle = F.exp(-square) * _ratio(x, ERFC_MIDDLE)
    far = F.exp(-square) / x * (1.0 / math.sqrt(math.pi) - inverse * _ratio(inverse, ERFC_FAR))
    return F.when(x <= 0.46875, near).when(x <= 4.0, middle).otherwise(far)


def chi2_upper_tail(x: Column, dof: Column) -> Column:
    """P(X > x) for a chi-squared variable with an integer number of degrees of freedom.

    The finite sum is carried in logarithms, so many degrees of freedom do not overflow.
    """
    half = x / 2.0
    odd = F.pmod(dof, F.lit(2)) == 1
    # ln of the first term: h^(1/2) e^-h / Gamma(3/2) for odd dof, e^-h for even dof
    first = F.when(odd, 0.5 * F.ln(half) - F.lit(math.lgamma(1.5)) - half).otherwise(-half)
    count = F.floor(dof / 2).cast("int")
    step = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    start = F.struct(first.alias("log_term"), F.lit(0.0).alias("total"))
    summed = F.aggregate(
        F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")),
        start,
        lambda acc, j: F.struct(
            (acc["log_term"] + F.ln(half / (j + step))).alias("log_term"),
            (acc["total"] + F.exp(acc["log_term"])).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    tail = F.when(odd, erfc(F.sqrt(half)) + summed).otherwise(summed)
    return F.when(x <= 0, F.lit(1.0)).otherwise(F.least(tail, F.lit(1.0)))

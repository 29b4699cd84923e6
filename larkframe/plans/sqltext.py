"""Builders of checking SQL: least squares by sweeping, and tail probabilities by numeric integration."""


def moments_sql(src: str, cols: list[str], name: str = "mom", by: str = "") -> str:
    g = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    pairs = [f"covar_pop({a}, {b}) AS a{i}_{j}" for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return f"{name} AS (SELECT {g}count(*) AS n, " + ", ".join([f"avg({c}) AS m{i}" for i, c in enumerate(cols)] + pairs) + f" FROM {src}{tail})"


def ols_sql(src: str, y: str, xs: list[str], by: str = "", ridge: str = "0", name: str = "ols") -> str:
    """Least squares of y on xs. ``ridge`` is text added to the diagonal, with {i} and {k} for the row and the outcome.

    CTEs ending in ``name`` with n, b0, b_<x>, rss, tss, s2, m_<x> and iv<i>_<j> (inverse of the centred cross products)."""
    cols = xs + [y]
    k, g = len(xs), (f"{by}, " if by else "")
    ctes = [moments_sql(src, cols, f"{name}_0", by)]
    ent = lambda f: ", ".join(f"{f(i, j)} AS a{i}_{j}" for i in range(k + 1) for j in range(k + 1))
    keep = g + "n, " + ", ".join(f"m{i}" for i in range(k + 1))
    first = ent(lambda i, j: f"a{i}_{j} + {ridge.format(i=i, k=k)}" if i == j and i < k and ridge != "0" else f"a{i}_{j}")
    ctes.append(f"{name}_1 AS (SELECT {keep}, a{k}_{k} AS yy, {first} FROM {name}_0)")
    for p in range(k):
        def f(i, j, p=p):
            if i == p and j == p:
                return f"-1 / a{p}_{p}"
            if i == p or j == p:
                return f"a{i}_{j} / a{p}_{p}"
            return f"a{i}_{j} - a{i}_{p} * a{p}_{j} / a{p}_{p}"
        ctes.append(f"{name}_{p + 2} AS (SELECT {keep}, yy, {ent(f)} FROM {name}_{p + 1})")
    b0 = f"m{k}" + "".join(f" - a{i}_{k} * m{i}" for i in range(k))
    out = [f"{b0} AS b0", f"n * a{k}_{k} AS rss", "n * yy AS tss", f"n * a{k}_{k} / (n - {k + 1}) AS s2"]
    out += [f"a{i}_{k} AS b_{x}" for i, x in enumerate(xs)] + [f"m{i} AS m_{x}" for i, x in enumerate(xs)]
    out += [f"-a{i}_{j} / n AS iv{i}_{j}" for i in range(k) for j in range(k)]
    ctes.append(f"{name} AS (SELECT {g}n, " + ", ".join(out) + f" FROM {name}_{k + 1})")
    return ",\n".join(ctes)


def ridge_sql(lam: str) -> str:
    """Diagonal term of a penalty on standardised predictors and outcome."""
    return f"{lam} / sqrt(a{{k}}_{{k}}) * a{{i}}_{{i}}"


def fitted_sql(xs: list[str], p: str = "") -> str:
    return f"({p}b0" + "".join(f" + {p}b_{x} * {x}" for x in xs) + ")"


def leverage_sql(xs: list[str], p: str = "") -> str:
    terms = "".join(f" + {p}iv{i}_{j} * ({a} - {p}m_{a}) * ({b} - {p}m_{b})" for i, a in enumerate(xs) for j, b in enumerate(xs))
    return f"(1.0::double / {p}n{terms})"


def _simpson(f: str, hi: str, steps: int = 4000) -> str:
    """Integral of f (text with X for the variable) from 0 to hi."""
    w = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    x = f"(({hi}) * i / {steps}::double)"
    return f"(({hi}) / {3 * steps}::double * list_sum(list_transform(range(0, {steps + 1}), lambda i: ({w}) * ({f.replace('X', x)}))))"


def t_p_sql(t: str, df: str) -> str:
    c = f"exp(lgamma((({df}) + 1) / 2.0::double) - lgamma(({df}) / 2.0::double)) / sqrt(({df}) * pi())"
    return f"(1 - 2 * {c} * {_simpson(f'pow(1 + X * X / ({df}), -(({df}) + 1) / 2.0::double)', f'abs({t})')})"


def f_p_sql(f: str, d1: str, d2: str) -> str:
    a, b = f"(({d1}) / 2.0::double)", f"(({d2}) / 2.0::double)"
    logc = f"lgamma({a} + {b}) - lgamma({a}) - lgamma({b}) + {a} * ln(({d1}) / ({d2})::double)"
    body = f"2 * pow(X, ({d1}) - 1) * exp({logc} - ({a} + {b}) * ln(1 + ({d1}) * X * X / ({d2})))"
    return f"(1 - {_simpson(body, f'sqrt({f})')})"


def chisq_p_sql(x: str, df: str) -> str:
    body = f"2 * pow(X, ({df}) - 1) * exp(-X * X / 2 - ({df}) / 2.0::double * ln(2) - lgamma(({df}) / 2.0::double))"
    return f"(1 - {_simpson(body, f'sqrt({x})')})"


def ks_p_sql(d: str, n: str, m: str) -> str:
    lam2 = f"(({n})::double * ({m}) / (({n}) + ({m})) * ({d}) * ({d}))"
    return f"least(1, greatest(0, 2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * {lam2})))))"


def t_quantile_sql(z: float, df: str) -> str:
    """t quantile for large df from the normal quantile z (Cornish-Fisher expansion)."""
    return (f"({z}::double + ({z ** 3 + z}::double) / (4 * ({df})) + ({5 * z ** 5 + 16 * z ** 3 + 3 * z}::double) / (96.0::double * ({df}) * ({df})))")


# Acklam's rational approximation of the normal quantile (relative error below 1.2e-9); fixed values, valid as Spark and as DuckDB SQL.
_A = ["-3.969683028665376e+01", "2.209460984245205e+02", "-2.759285104469687e+02", "1.383577518672690e+02", "-3.066479806614716e+01", "2.506628277459239e+00"]
_B = ["-5.447609879822406e+01", "1.615858368580409e+02", "-1.556989798598866e+02", "6.680131188771972e+01", "-1.328068155288572e+01", "1e0"]
_C = ["-7.784894002430293e-03", "-3.223964580411365e-01", "-2.400758277161838e+00", "-2.549732539343734e+00", "4.374664141464968e+00", "2.938163982698783e+00"]
_D = ["7.784695709041462e-03", "3.224671290700398e-01", "2.445134137142996e+00", "3.754408661907416e+00", "1e0"]


def _poly(c: list[str], x: str) -> str:
    out = c[0]
    for v in c[1:]:
        out = f"({out} * {x} + {v})"
    return out


def normal_quantile_text(p: str) -> str:
    mid, q = f"({p} - 0.5e0)", f"(({p} - 0.5e0) * ({p} - 0.5e0))"
    low, high = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))"
    return (f"CASE WHEN {p} < 0.02425e0 THEN {_poly(_C, low)} / {_poly(_D, low)} WHEN {p} > 0.97575e0 THEN -{_poly(_C, high)} / {_poly(_D, high)} "
            f"ELSE {_poly(_A, q)} * {mid} / {_poly(_B, q)} END")

"""SQL building blocks for computations inside one row's arrays."""

from __future__ import annotations


def lit(s: str) -> str:
    """A Spark SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, name: str, body: str) -> str:
    """body with `name` bound to value, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def running(values: str, op: str) -> str:
    """Running op ({x}: later, {y}: earlier) of an array: each round reaches twice as far back, so n elements cost n log n steps."""
    back = "a_[i_ - shiftleft(1, k_)]"
    return f"aggregate(sequence(0, cast(ceil(log2(size({values}) + 1)) as int)), {values}, (a_, k_) -> transform(a_, (x_, i_) -> case when i_ >= shiftleft(1, k_) then {op.format(x='x_', y=back)} else x_ end))"


def stretches(starts: str, value: str, total: str) -> str:
    """Rows (from, after, value) of the stretches that begin at the places `starts`; value is SQL over `p`, the place."""
    body = f"transform(s_, (p, k) -> named_struct('from', p, 'after', coalesce(try_element_at(s_, k + 2), {total}), 'value', {value}))"
    return let(starts, "s_", body)


def rounded(value: str, digits: int) -> str:
    """SQL: a double from 0 to 4 rounded to at most 5 digits on its binary value, half to even."""
    # Exact: powers of two only move the point; a whole number of 2**-100, and what lies below decides no tie.
    one, half = f"cast('{1 << 100}' as decimal(31,0))", f"cast('{1 << 99}' as decimal(31,0))"
    high, low = f"cast(x_ * {1 << 45}D as bigint)", f"cast((x_ * {1 << 45}D - h_) * {1 << 55}D as bigint)"
    whole = f"(cast(h_ as decimal(15,0)) * cast({1 << 55} as decimal(17,0)) + cast({low} as decimal(17,0))) * cast({10**digits} as decimal(6,0))"
    rest = f"(n_ - cast(q_ as decimal(7,0)) * {one})"
    near = let(whole, "n_", let(f"n_ div {one}", "q_", let(rest, "r_", f"(q_ + if(r_ > {half} or (r_ = {half} and q_ % 2 = 1), 1, 0)) / {10**digits}D")))
    return let(value, "x_", f"case when x_ is not null then {let(high, 'h_', near)} end")

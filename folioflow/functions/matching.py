"""Sequence matching inside a row: Ratcliff-Obershelp ratios as SQL, with no Python worker.

A text becomes numbers, one per character.  A ladder of arrays holds, for every
place, a 64-bit hash of the stretch of 1, 2, 4, ... characters that begins there;
a stretch of any length in between is known by the hashes of its two overlapping
halves.  Whether two windows share a stretch of a length is then one set
operation, and as shorter stretches are shared wherever longer ones are, the
longest is found by doubling and halving.  Windows still open are an explicit
stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sqlparts import let, rounded

#: From so many characters on, those that make up more than a hundredth (and one) of the second text begin no match (fixed values).
POPULAR_FROM, POPULAR_SHARE = 200, 100
_RECT = "array<struct<a:int,b:int,c:int,d:int>>"


def characters(text: str) -> str:
    """SQL: the code points of a text."""
    return f"transform(regexp_extract_all({text}, '(?s).', 0), c_ -> cast(ascii(c_) as bigint))"


def _ladder(numbers: str) -> str:
    """SQL: per k the hashes of the stretches of 2^k characters from every place, k = 0 the characters themselves."""
    grown = let("element_at(w_, -1)", "l_", "zip_with(slice(l_, 1, size(l_) - shiftleft(1, k_ - 1)), slice(l_, 1 + shiftleft(1, k_ - 1), size(l_) - shiftleft(1, k_ - 1)), (x_, y_) -> xxhash64(x_, y_))")
    return f"aggregate(sequence(0, top_), array({numbers}), (w_, k_) -> case when k_ = 0 then w_ else array_append(w_, {grown}) end)"


def _unpopular(numbers: str) -> str:
    """SQL: a long text's characters, popular ones as -1, which no text holds."""
    runs = "aggregate(o_, named_struct('n', 0, 'v', -1L, 'out', cast(array() as array<bigint>)), (s_, x_) -> case when x_ = s_.v then named_struct('n', s_.n + 1, 'v', x_, 'out', case when s_.n = most_ then array_append(s_.out, x_) else s_.out end) else named_struct('n', 1, 'v', x_, 'out', s_.out) end, s_ -> s_.out)"
    popular = let(f"array_sort({numbers})", "o_", let(f"cast(size(o_) div {POPULAR_SHARE} + 1 as int)", "most_", runs))
    return let(popular, "pop_", f"transform({numbers}, x_ -> case when array_contains(pop_, x_) then -1L else x_ end)")


def _window(side: str, at: str, size: str, length: str) -> str:
    """SQL: hashes of a window's stretches of `length` characters, 2^h_ <= length < 2^(h_ + 1)."""
    n = f"{size} - {length} + 1"
    whole = f"slice({side}[h_], {at} + 1, {n})"
    return f"case when {length} = shiftleft(1, h_) then {whole} else zip_with({whole}, slice({side}[h_], {at} + 1 + {length} - shiftleft(1, h_), {n}), (x_, y_) -> xxhash64(x_, y_)) end"


def _longest(rect: str) -> str:
    """SQL: struct(i, j, k): the longest stretch of a window (a, b) of u_ and (c, d) of v_, of equals the first in u_, then in v_; k 0 where they share none."""
    r = rect
    la, lb = f"({r}.b - {r}.a)", f"({r}.d - {r}.c)"
    n = f"least({la}, {lb})"
    pair = f"arrays_overlap(slice(u_[p_], {r}.a + 1, {la} - shiftleft(1, p_) + 1), slice(v_[p_], {r}.c + 1, {lb} - shiftleft(1, p_) + 1))"
    doubled = f"aggregate(sequence(0, top_), -1, (g_, p_) -> case when g_ = p_ - 1 and shiftleft(1, p_) <= {n} and {pair} then p_ else g_ end)"
    more = "g_ + shiftleft(1, h_ - p_)"
    both = lambda length: (_window("u_", f"{r}.a", la, length), _window("v_", f"{r}.c", lb, length))
    x, y = both("m_")
    halved = f"aggregate(sequence(0, h_), shiftleft(1, h_), (g_, p_) -> case when p_ = 0 then g_ else {let(more, 'm_', f'case when m_ <= {n} and arrays_overlap({x}, {y}) then m_ else g_ end')} end)"
    x, y = both("k_")
    first = let("array_intersect(x_set, y_set)[0]", "hit_", f"named_struct('i', {r}.a + cast(array_position(x_set, hit_) as int) - 1, 'j', {r}.c + cast(array_position(y_set, hit_) as int) - 1, 'k', k_)")
    found = let(halved, "k_", let(x, "x_set", let(y, "y_set", first)))
    return let(doubled, "h_", f"case when h_ < 0 then named_struct('i', {r}.a, 'j', {r}.c, 'k', 0) else {found} end")


def _grown(rect: str) -> str:
    """SQL: the stretch f_, longer by equal characters on both sides, popular ones too (s_, t_: the characters of both texts)."""
    r = rect

    def reach(most: str, x: str, y: str) -> str:
        step = f"case when g_ + q_ <= {most} and slice(s_, {x}, q_) = slice(t_, {y}, q_) then g_ + q_ else g_ end"
        return f"aggregate(sequence(0, top_ + 1), 0, (g_, p_) -> {let('shiftleft(1, top_ + 1 - p_)', 'q_', step)})"

    left = reach(f"least(f_.i - {r}.a, f_.j - {r}.c)", "f_.i - g_ - q_ + 1", "f_.j - g_ - q_ + 1")
    right = reach(f"least({r}.b - f_.i - f_.k, {r}.d - f_.j - f_.k)", "f_.i + f_.k + g_ + 1", "f_.j + f_.k + g_ + 1")
    return let(left, "left_", let(right, "right_", "named_struct('i', f_.i - left_, 'j', f_.j - left_, 'k', f_.k + left_ + right_)"))


def matched(a: str, b: str) -> str:
    """SQL: how many characters Ratcliff-Obershelp matching pairs up, with the rule for popular characters of a long second text."""
    r = "r_"
    best = let(_longest(r), "f_", f"case when junk_ then {_grown(r)} else f_ end")
    before = f"case when m2_.i > {r}.a and m2_.j > {r}.c then array(named_struct('a', {r}.a, 'b', m2_.i, 'c', {r}.c, 'd', m2_.j)) else cast(array() as {_RECT}) end"
    after = f"case when m2_.i + m2_.k < {r}.b and m2_.j + m2_.k < {r}.d then array(named_struct('a', m2_.i + m2_.k, 'b', {r}.b, 'c', m2_.j + m2_.k, 'd', {r}.d)) else cast(array() as {_RECT}) end"
    rest = "slice(z_.open, 1, size(z_.open) - 1)"
    step = let(
        "element_at(z_.open, -1)",
        r,
        let(best, "m2_", f"case when m2_.k = 0 then named_struct('open', {rest}, 'n', z_.n) else named_struct('open', concat({rest}, {before}, {after}), 'n', z_.n + m2_.k) end"),
    )
    start = f"named_struct('open', cast(array(named_struct('a', 0, 'b', size(s_), 'c', 0, 'd', size(t_))) as {_RECT}), 'n', 0)"
    # A stretch leaves two windows at most, and each but the first follows from a stretch.
    walk = f"aggregate(sequence(0, 2 * least(size(s_), size(t_))), {start}, (z_, i_) -> case when size(z_.open) = 0 then z_ else {step} end, z_ -> z_.n)"
    body = let(_ladder("s_"), "u_", let(_ladder("w0_"), "v_", walk))
    body = let(f"case when junk_ then {_unpopular('t_')} else t_ end", "w0_", body)
    body = let("cast(floor(log2(least(size(s_), size(t_)))) as int)", "top_", body)
    body = let(f"size(t_) >= {POPULAR_FROM}", "junk_", f"case when least(size(s_), size(t_)) = 0 then 0 else {body} end")
    return let(characters(a), "s_", let(characters(b), "t_", body))


def ratio_sql(a: str, b: str) -> str:
    """SQL: twice the matched characters over all of both; 1 for two empty texts, null where either is null."""
    share = f"case when a_ is null or b_ is null then null when a_ = b_ then 1D else 2D * {matched('a_', 'b_')} / (char_length(a_) + char_length(b_)) end"
    return let(a, "a_", let(b, "b_", share))


def ratio(a: str, b: str) -> Column:
    """The similarity ratio of two columns; the order of the two matters."""
    return F.expr(ratio_sql(a, b))


#: Least window, text looked at, and how much longer than the needle a text must be to be looked at in windows (fixed values).
WINDOW, LOOKED, SLACK = 8, 500, 4


def windowed_ratio(needle: str, text: str) -> str:
    """SQL: how much of a needle a text holds: 1 if it is in there, else the best ratio over windows of its length.

    Windows are WINDOW characters at least, a quarter of their length apart, and
    start where one still ends within the first LOOKED characters; a text hardly
    longer than the needle is compared whole.
    """
    pieces = f"transform(sequence(0, greatest(0, least({LOOKED}, char_length(h2_)) - w2_), greatest(1, w2_ div 4)), i2_ -> substring(h2_, cast(i2_ as int) + 1, w2_))"
    pieces = let(f"greatest({WINDOW}, char_length(n2_))", "w2_", f"case when char_length(h2_) - char_length(n2_) <= {SLACK} then array(h2_) else array_distinct({pieces}) end")
    # No more characters match than both have in common, whatever their order; windows go by that, and those that cannot win are passed over.
    count = lambda text: f"char_length({text}) - char_length(replace({text}, x2_, ''))"
    common = f"aggregate(d2_, 0, (g2_, x2_) -> g2_ + least({count('n2_')}, {count('e2_')}))"
    line = let("array_distinct(regexp_extract_all(n2_, '(?s).', 0))", "d2_", f"sort_array(transform({pieces}, e2_ -> named_struct('b', 2D * {common} / (char_length(n2_) + char_length(e2_)), 'e', e2_)), false)")
    best = f"aggregate({line}, 0D, (g2_, p2_) -> case when p2_.b > g2_ then greatest(g2_, {ratio_sql('n2_', 'p2_.e')}) else g2_ end)"
    return let(needle, "n2_", let(text, "h2_", f"case when n2_ = '' or h2_ = '' then 0D when contains(h2_, n2_) then 1D else {best} end"))


#: The keywords' weight, the cap without and the floor with all groups of keywords (fixed values).
KEYWORDS, CAP, FLOOR = 0.82, 0.52, 0.78


def section_score(title: str, head: str, keywords: str, groups: str) -> str:
    """SQL: what a page's head is worth to a section, to three places; all arguments normalised."""
    held = lambda x: f"({x} <> '' and contains(hd_, {x}))"
    share = f"(size(filter(kw_, k3_ -> {held('k3_')})) / greatest(1, size(kw_)))"
    best = f"greatest(r3_, {share} * {KEYWORDS}D + r3_ * 0.18D)"
    every = f"forall(gr_, g3_ -> exists(g3_, a3_ -> {held('a3_')}))"
    capped = let(best, "b3_", f"case when size(gr_) = 0 then b3_ when {every} then greatest(b3_, {FLOOR}D) else least(b3_, {CAP}D) end")
    body = let(windowed_ratio("coalesce(" + title + ", '')", "hd_"), "r3_", rounded(capped, 3))
    none = "cast(array() as array<string>)"
    return let(f"coalesce({head}, '')", "hd_", let(f"coalesce({keywords}, {none})", "kw_", let(groups, "gr_", body)))

"""Tables with spans at any depth, captions of buttons, visible parts of hidden ones."""

import random
import time

import pytest

from millrace.llm.html_text import visible_text


@pytest.mark.parametrize(
    "page,text",
    [
        ("<table><tr><td rowspan=2>A<td>b1<tr><td>b2<tr><td>LONGER<td>c</table>", "A       b1\n        b2\nLONGER  c"),
        ("<table><tr><th colspan=2>head<th>z<tr><td>a<td>b<td>c</table>", "head  z\na  b  c"),
        ("<table><tr><th colspan=2>a long head<th>z<tr><td>a<td>b<td>c</table>", "a long head  z\na  b         c"),
        ("<table><tr><td rowspan=0>A<td>1<tr><td>2<tr><td>3</table>", "A  1\n   2\n   3"),
        ("<table><tbody><tr><td rowspan=9>A<td>1</tbody><tbody><tr><td>B<td>2</tbody></table>", "A  1\nB  2"),
        ("<table><caption>all</caption><tr><td colspan=x>a<td colspan=0>b<tr><td>cc<td>d</table>", "all\na   b\ncc  d"),
        ("<form><input type=submit value='Send it'> or <input type=text value=no><input type=RESET value=Undo></form>", "Send it or Undo"),
        ("<div style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</div>", "yes"),
        ("<div style='display:none'>no <b style='visibility:visible'>no</b></div>x", "x"),
        ("<table style='visibility:hidden'><tr><td>no<td style='visibility:visible'>yes</table>", "yes"),
    ],
)
def test_layout(page, text):
    lines = [x.rstrip() for x in visible_text(page).split("\n")]
    if "visibility" in page and "table" in page:
        lines = [x.strip() for x in lines]
    assert "\n".join(lines) == text


def test_columns_stay_aligned_at_any_depth():
    for depth in (1, 6, 7, 40):
        inner = "<table><tr><td>a<td>b<tr><td>long<td>c</table>"
        page = "<table><tr><td>" * depth + inner + "</table>" * depth
        assert visible_text(page).split("\n") == ["a     b", "long  c"]


def test_random_tables_are_laid_out_as_a_plain_grid_says():
    r = random.Random(4)
    for _ in range(300):
        rows, page = [], "<table>"
        for i in range(r.randrange(1, 6)):
            page += "<tr>"
            row = [(f"t{i}x{k}" + "y" * r.randrange(5), r.choice([1, 1, 1, 2, 3]), r.choice([1, 1, 1, 2, 3])) for k in range(r.randrange(2, 5))]
            rows.append(row)
            page += "".join(f"<td colspan={w} rowspan={h}>{t}" for t, w, h in row)
        taken, start = {}, {}
        for i, row in enumerate(rows):
            x = 0
            for t, w, h in row:
                while (i, x) in taken:
                    x += 1
                for y in range(i, i + h):
                    for z in range(x, x + w):
                        taken.setdefault((y, z), t)
                start[t] = (i, x)
                x += w
        lines = visible_text(page + "</table>").split("\n")
        place = {t: lines[i].index(t) for t, (i, _) in start.items()}
        # One column has one place, and columns come in order.
        by_column = {}
        for t, (_, x) in start.items():
            assert by_column.setdefault(x, place[t]) == place[t]
        order = [by_column[x] for x in sorted(by_column)]
        assert order == sorted(order) and len(lines) == len(rows)


def test_long_pages_take_time_in_proportion():
    begin = time.time()
    loose = visible_text("<table>" + "w <b>x</b> " * 20_000 + "<tr><td>a</table>")
    assert loose.count("x") == 20_000
    wide = visible_text("<table><tr><td>" + "z" * 300_000 + "<td>b" + "<tr><td>a<td>b" * 5_000 + "</table>")
    assert len(wide) < 3_000_000 and wide.count("b") == 5_001
    deep = visible_text("<table><tr><td>" * 3_000 + "x")
    assert deep == "x" and time.time() - begin < 20

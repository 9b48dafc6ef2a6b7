import pytest
from hypothesis import given, settings, strategies as st

from vitrine.sources.htmltree import (
    ALL_NODES, KIND, LAST, PARENT, PRE, SOLE, T0, T1, TAG, TEXT, Keep, TreeBuilder,
)


def build(html, keep=ALL_NODES, **kw):
    return TreeBuilder(keep, **kw).build(html)


def test_short_text_is_carried_and_long_text_is_sliced():
    tree = build("<p>" + "x" * 300 + "<b>y<i>z</i></b></p>")
    p, b = (n for n in tree.nodes if n[TAG] in ("p", "b"))
    assert p[TEXT] is None and text(tree, p) == "x" * 300 + "yz" and b[TEXT] == "yz"


def elements(tree):
    return {n[TAG] + str(n[PRE]): n for n in tree.nodes if n[KIND] == "element"}


def text(tree, node):
    return tree.text[node[T0]:node[T1]]


def test_unclosed_tags_stay_open():
    tree = build("<div><p>a<p>b</div>c")
    div, first, second = [n for n in tree.nodes if n[KIND] == "element"]
    assert second[PARENT] == first[PRE] and text(tree, first) == "ab"
    assert text(tree, div) == "ab" and tree.text == "abc"


def test_end_tag_without_start_is_ignored_but_splits_strings():
    tree = build("<div>ab</i>cd</div>")
    assert tree.text == "abcd"
    assert [n[KIND] for n in tree.nodes] == ["element", "text", "text"]
    assert tree.nodes[0][SOLE] is None


def test_void_elements_never_stay_open():
    tree = build("<p>a<br>b<img src=x>c</p>")
    p = tree.nodes[0]
    assert text(tree, p) == "abc"
    assert all(n[LAST] == n[PRE] for n in tree.nodes if n[TAG] in ("br", "img"))


def test_script_text_is_not_page_text():
    tree = build('<div>a<script>var t="</p>";</script>b<!-- c --></div>')
    assert tree.text == "ab"
    script = next(n for n in tree.nodes if n[TAG] == "script")
    assert script[TEXT] == 'var t="</p>";'


def test_cut_off_page():
    tree = build("<div><h1>Name</h1><p>text <b")
    assert "Name" in tree.text and elements(tree)["h11"][LAST] == 2


def test_entities_and_odd_markup():
    tree = build("<p>&copy; a &amp; b &lt;i&gt; 1 < 2 <3></p><!doctype html><?x y>")
    assert tree.text == "© a & b <i> 1 < 2 <3>"


@pytest.mark.parametrize(
    "html,expected",
    [("<b>a</b>   <b>b</b>", "a b"), ("<b>a</b> \n <b>b</b>", "a\nb"), ("<pre>  </pre>", "  ")],
)
def test_blank_strings_shrink_outside_pre(html, expected):
    assert build(html).text == expected


def test_only_child_string_is_handed_up():
    tree = build("<div><b>x</b></div><div>y<b>x</b></div>")
    divs = [n for n in tree.nodes if n[TAG] == "div"]
    assert divs[0][SOLE] == 2 and divs[1][SOLE] is None


def test_template_text_is_its_own():
    tree = build("<div>a<template>t<b>u</b></template></div>")
    template = next(n for n in tree.nodes if n[TAG] == "template")
    assert tree.text == "a" and template[TEXT] == "tu"


def test_repeated_attribute_last_wins():
    tree = build('<a href="1" href="2" class="x" class="y  z">')
    assert dict(tree.nodes[0][6])["href"] == "2" and tree.nodes[0][5] == " y z "


def test_keep_emits_only_wanted_nodes_with_same_numbers():
    html = '<div class="a"><p>x</p><b class="c d">y</b></div>'
    every = {n[PRE]: n for n in build(html).nodes}
    some = build(html, Keep(tokens=frozenset(["d"]))).nodes
    assert [n[TAG] for n in some] == ["b"]
    assert some[0][:6] == every[some[0][PRE]][:6]


def test_markup_is_cleaned_and_sliced():
    tree = build(
        '<i>x</i><div class="a  b" style="s"><script>1</script><p onclick="k" id=\'q"\'>1 &lt; 2</p><br></div>',
        markup_attrs=("class", "id"), markup_skip=("script",), markup_keep=Keep(tags=frozenset(["div"])),
    )
    assert tree.markup == '<div class="a b"><p id=\'q"\'>1 &lt; 2</p><br/></div>'


PIECES = st.sampled_from(
    ["<p>", "</p>", '<div class="a b">', "</div>", "<br/>", "<", ">", "</", "&amp;", "&", "a", " ", "\n",
     "<!--", "-->", "<script>", "</script>", "<a href='x>y'>", "<img src=x/>", "<style>", "</style>", "<x y=\"z"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=15).map("".join))
def test_any_source_gives_a_consistent_tree(html):
    builder = TreeBuilder(ALL_NODES)
    tree = builder.build(html)
    again = builder.build(html)  # remembered tags change nothing
    assert tree == again
    by_pre = {n[PRE]: n for n in tree.nodes}
    assert sorted(by_pre) == [n[PRE] for n in tree.nodes] == list(range(len(tree.nodes)))
    for node in tree.nodes:
        assert node[PRE] <= node[LAST] and node[T0] <= node[T1] <= len(tree.text)
        if node[PARENT] >= 0:
            parent = by_pre[node[PARENT]]
            assert parent[PRE] < node[PRE] <= node[LAST] <= parent[LAST]
            assert parent[T0] <= node[T0] and node[T1] <= parent[T1]
        if node[KIND] == "element" and node[TAG] not in ("script", "style"):
            assert node[TEXT] == tree.text[node[T0]:node[T1]]


def test_keep_inside_a_scope():
    html = "<a>1</a><nav><p><a>2</a></p><nav><a>3</a></nav><a>4</a></nav><a>5</a>"
    nav = Keep(tags=frozenset(["nav"]))
    tree = build(html, Keep(inner=Keep(tags=frozenset(["a"])), outer=nav))
    assert [text(tree, n) for n in tree.nodes] == ["2", "3", "4"]


def test_broken_pages_take_linear_time():
    """Constructs that nothing closes are not scanned to the end of the page again and again."""
    import time

    from vitrine.sources.htmltree import Keep, TreeBuilder

    for piece in ("<!-- x ", '<a b="', "<?x ", "<!x ", "</a "):
        def seconds(n, piece=piece):
            page = piece * n
            best = 9e9
            for _ in range(2):
                start = time.perf_counter()
                TreeBuilder(Keep()).build(page)
                best = min(best, time.perf_counter() - start)
            return best

        small, large = seconds(4000), seconds(16000)
        assert large < 12 * small + 0.2, (piece, small, large)


def test_unclosed_script_keeps_the_rest():
    from vitrine.sources.htmltree import TAG, TEXT, Keep, TreeBuilder

    tree = TreeBuilder(Keep(everything=True)).build("<p>a</p><script>tail <b>x</b>")
    assert [n[TEXT] for n in tree.nodes if n[TAG] == "script"] == ["tail <b>x</b>"]

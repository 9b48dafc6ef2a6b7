"""Turn one HTML page into flat node rows (the only per-page Python step).

Spark cannot express a tag stack, so this helper walks a page once and emits
flat rows; every selector, rule and report afterwards is a Spark expression over
those rows.  Two tricks keep the rows small:

* a subtree is a range: descendants of ``e`` are the nodes with
  ``e.pre < pre <= e.last``;
* the text (and the cleaned markup) of a subtree is a *slice* of one page-level
  string, so nodes carry offsets, and copies only of short texts;
* ``cls`` is the class list with a space on both sides, so one substring test
  finds a whole class token.

Tree rules are those of the lenient standard-library parser: nothing is
repaired, an end tag closes the nearest open element of that name and is ignored
if there is none, void elements never stay open.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser

# Elements that never have content.
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source "
    "track wbr basefont bgsound command frame image isindex nextid spacer".split()
)
# Elements whose strings are not part of the surrounding text.
STRING_CONTAINERS = frozenset(("script", "style", "template", "rt", "rp"))
# Elements inside which white space is kept as written.
PRESERVE_SPACE = frozenset(("pre", "textarea"))
ASCII_SPACE = " \n\t\f\r"

# Slots of one node row.  The first NODE_WIDTH slots are emitted, in the order of
# the Arrow struct in ``parse.py``; the rest is bookkeeping while the node is open.
PRE, LAST, PARENT, KIND, TAG, CLS, ATTRS, TEXT, T0, T1, H0, H1, SOLE = range(13)
NODE_WIDTH = 13
CHILDREN, KEPT, OWN, HITS = 13, 14, 15, 16  # OWN: own strings, or where the element's texts start


@dataclass(frozen=True)
class Keep:
    """Which nodes the parse step emits: the rules' own filter, pushed down.

    A node is emitted when *any* member condition holds, or when it passes
    ``inner`` below an element that passes ``outer``.  ``everything`` turns the
    filter off.  ``attr_names`` limits the attribute map (None = all).
    """

    everything: bool = False
    tags: frozenset = frozenset()
    tokens: frozenset = frozenset()
    exact_classes: frozenset = frozenset()
    class_parts: frozenset = frozenset()
    attr_values: frozenset = frozenset()  # (name, value) pairs
    attr_heads: frozenset = frozenset()  # (name, start of value) pairs
    attrs: frozenset = frozenset()  # (tag or None, name) pairs
    strings: frozenset = frozenset()  # emit strings containing one of these
    attr_names: frozenset | None = frozenset()
    inner: "Keep | None" = None
    outer: "Keep | None" = None

    def __or__(self, other: "Keep") -> "Keep":
        names = (
            None
            if self.attr_names is None or other.attr_names is None
            else self.attr_names | other.attr_names
        )
        return Keep(
            self.everything or other.everything,
            self.tags | other.tags,
            self.tokens | other.tokens,
            self.exact_classes | other.exact_classes,
            self.class_parts | other.class_parts,
            self.attr_values | other.attr_values,
            self.attr_heads | other.attr_heads,
            self.attrs | other.attrs,
            self.strings | other.strings,
            names,
            _either(self.inner, other.inner),
            _either(self.outer, other.outer),
        )


def _either(a, b):
    return b if a is None else a if b is None else a | b


@dataclass(frozen=True)
class Own:
    """What one selector asks of an element itself, its ancestors aside; all must hold."""

    tag: str | None = None
    cls_parts: tuple = ()
    cls_exact: str | None = None
    attr_is: tuple = ()
    attr_part: tuple = ()
    attr_head: tuple = ()

    def fits_class(self, tag, cls) -> bool:
        if self.tag and tag != self.tag:
            return False
        if cls is None and (self.cls_parts or self.cls_exact is not None):
            return False
        return all(part in cls for part in self.cls_parts) and (self.cls_exact is None or cls == self.cls_exact)

    def fits_attrs(self, attrs) -> bool:
        return (
            all(attrs.get(name) == value for name, value in self.attr_is)
            and all(value in attrs.get(name, "") and name in attrs for name, value in self.attr_part)
            and all(name in attrs and attrs[name].startswith(value) for name, value in self.attr_head)
        )


ALL_NODES = Keep(everything=True, attr_names=None)


@dataclass
class PageTree:
    """Result for one page; ``nodes`` holds row lists in document order."""

    text: str
    markup: str
    nodes: list = field(default_factory=list)
    hits: list = field(default_factory=list)  # per asked selector the places of its elements in ``nodes``


# Plain tags, read with one match each.  Anything else in a page (comments,
# declarations, odd attributes, broken tags) goes to the library's own methods.
_NAME = r"[a-zA-Z][-.a-zA-Z0-9:_]*+"
_ATTR_NAME = r"[a-zA-Z_:@][-.a-zA-Z0-9:_@]*+"
_BARE = r"[^\s\"'<>=`/&]++(?=[\s>]|\Z)"
_START = re.compile(
    rf"""<({_NAME})((?:\s++{_ATTR_NAME}(?:=(?:"[^"]*+"|'[^']*+'|{_BARE}))?+)*+)\s*+(/?)>"""
)
_END = re.compile(rf"</({_NAME})\s*+>")
_ATTR = re.compile(rf"""({_ATTR_NAME})(?:=(?:"([^"]*)"|'([^']*)'|({_BARE})))?""")
_RAW_END = {tag: re.compile(rf"</\s*{tag}\s*>", re.I) for tag in ("script", "style")}
# Start and end tags repeat a lot within a site, so their meaning is remembered by
# their source text: up to this length and number.
_TAG_MAX = 200
_TAGS_MAX = 20000
# Emitted elements with at most this much text carry it themselves; cutting it out of
# a long page text would cost more than the copy.
_SHORT_TEXT = 256


class TreeBuilder(HTMLParser):
    """Reusable builder; call :meth:`build` once per page."""

    def __init__(self, keep: Keep, markup_attrs=None, markup_skip=(), markup_keep=ALL_NODES, with_text=True, selectors=()):
        super().__init__(convert_charrefs=True)
        self._keep = keep
        self._markup_attrs = None if markup_attrs is None else frozenset(markup_attrs)
        self._markup_skip = frozenset(markup_skip)
        self._markup_keep = markup_keep
        self._with_text = with_text
        self._selectors = selectors
        self._by_class: dict = {}  # (tag, class list) -> the selectors these fit
        self._marked = (
            re.compile("|".join(map(re.escape, sorted(keep.strings)))).search
            if keep.strings else None
        )
        self._tags: dict = {}  # source of a plain tag -> what it means
        self._events: list = []

    def _fitting(self, tag, cls):
        """The asked selectors that a tag and class list fit, attributes aside."""
        found = self._by_class.get((tag, cls))
        if found is None:
            found = [(number, own) for number, own in enumerate(self._selectors) if own.fits_class(tag, cls)]
            if len(self._by_class) >= _TAGS_MAX:
                self._by_class.clear()
            if len(cls or "") <= _TAG_MAX:
                self._by_class[tag, cls] = found
        return found

    def no_hits(self) -> list:
        """An empty list for each asked selector."""
        return [[] for _ in self._selectors]

    # The library's callbacks only note what they saw.
    def handle_starttag(self, tag, attrs):
        self._events.append(("open", tag, attrs))

    def handle_startendtag(self, tag, attrs):
        self._events.append(("single", tag, attrs))

    def handle_endtag(self, tag):
        self._events.append(("close", tag, None))

    def handle_data(self, data):
        self._events.append(("text", data, None))

    def handle_comment(self, data):
        self._events.append(("comment", data, "<!--" + data + "-->"))

    def handle_decl(self, decl):
        self._events.append(("comment", decl, "<!" + decl + ">"))

    def handle_pi(self, data):
        self._events.append(("comment", data, "<?" + data + ">"))

    def unknown_decl(self, data):
        if data[:6].upper() == "CDATA[":
            self._events.append(("cdata", data[6:], "<![" + data + "]]>"))
        else:
            self._events.append(("comment", data, "<!" + data + ">"))

    def updatepos(self, i, j):  # line numbers are never used
        return j

    def _odd(self, html, at):
        """Read one construct the fast patterns do not cover; returns its end.

        Where nothing further on can close it, it is not scanned for its end.
        """
        follows = html[at + 1 : at + 2]
        opens = follows in ("/", "?", "!") or (follows.isalpha() and follows.isascii())
        if opens and (at > self._last_close or html.startswith("<!--", at) and at > self._last_comment):
            end = -1
        elif follows.isalpha() and follows.isascii():
            end = self.parse_starttag(at)
        elif follows == "/":
            end = self.parse_endtag(at)
        elif follows == "?":
            end = self.parse_pi(at)
        elif follows == "!":
            comment = html.startswith("<!--", at)
            end = self.parse_comment(at) if comment else self.parse_html_declaration(at)
        else:
            end = at + 1
            self.handle_data("<")
        if end < 0:  # never closed: plain text up to the next bracket
            end = html.find(">", at + 1) + 1 if at < self._last_close else 0
            if not end:
                end = html.find("<", at + 1)
                if end < 0:
                    end = at + 1
            self.handle_data(unescape(html[at:end]))
        return end

    def _opening(self, tag, attrs, single):
        """All a start tag means for the walk, independent of its place."""
        cls = None
        for name, value in attrs:
            if name == "class":
                cls = f" {' '.join(value.split())} " if value else "  "
        names = self._keep.attr_names
        # a repeated attribute: the last one wins, at the place of the first
        kept = {n: v or "" for n, v in attrs if names is None or n in names}
        hits = [number for number, own in self._fitting(tag, cls) if own.fits_attrs(kept)]
        kept = list(kept.items())
        piece, shows = "", False
        if self._markup_attrs is not None:
            piece = _start_markup(tag, attrs, cls, self._markup_attrs)
            shows = _wants(self._markup_keep, tag, cls, attrs)
        keep = self._keep
        wanted = _wants(keep, tag, cls, attrs)
        inner = keep.inner is not None and _wants(keep.inner, tag, cls, attrs)
        outer = keep.outer is not None and _wants(keep.outer, tag, cls, attrs)
        return tag, cls, kept or None, wanted, inner, outer, piece, shows, hits, single or tag in VOID_TAGS

    def _plain_tag(self, html, at):
        """(what a plain tag means, its end), or None for anything else."""
        match = _START.match(html, at)
        if match is not None:
            tag, section, slash = match.groups()
            meaning = self._opening(tag.lower(), _attributes(section) if section else (), bool(slash))
        else:
            match = _END.match(html, at)
            if match is None:
                return None
            meaning = (match.group(1).lower(),)
        end = match.end()
        if end - at <= _TAG_MAX and html.find(">", at) == end - 1:
            if len(self._tags) >= _TAGS_MAX:
                self._tags.clear()
            self._tags[html[at:end]] = meaning
        return meaning, end

    def build(self, html: str) -> PageTree:
        keep_all, marked = self._keep.everything, self._marked
        tags, markup_skip = self._tags, self._markup_skip
        events = self._events = []
        stack: list = []  # open elements
        open_count: dict = {}
        out: list = []
        late = False
        buffered: list = []  # pieces of the current string
        texts: list = []
        text_len = 0
        shown: list = []
        shown_len = 0
        scope = 0  # open elements since the outermost one passing ``keep.outer``
        showing = 0  # open elements since the outermost one with markup
        skipped = 0  # open elements left out of the markup
        holders: list = []  # open string containers
        preserving = 0
        count = 0  # nodes so far

        def put(piece):
            nonlocal shown_len
            shown.append(piece)
            shown_len += len(piece)

        def open_element(tag, cls, attrs, wanted, inner, outer, piece, shows, hits, single):
            nonlocal count, preserving, skipped, showing, scope
            if buffered:
                flush()
            if scope:
                scope += 1
                wanted = wanted or inner
            elif outer:
                scope = 1
            row = [count, count, -1, "element", tag, cls, attrs, None,
                   text_len, 0, shown_len, 0, None, 0, wanted, len(texts), hits]
            count += 1
            if stack:
                parent = stack[-1]
                row[PARENT] = parent[PRE]
                parent[CHILDREN] += 1
                parent[SOLE] = None
            stack.append(row)
            open_count[tag] = open_count.get(tag, 0) + 1
            if tag in STRING_CONTAINERS:
                row[OWN] = []
                holders.append(row)
            elif tag in PRESERVE_SPACE:
                preserving += 1
            if shows or showing:
                showing += 1
                if tag in markup_skip:
                    skipped += 1
                elif not skipped:
                    put(piece)
            if wanted:
                out.append(row)
            if single:
                pop()

        def pop():
            nonlocal preserving, skipped, showing, scope
            row = stack.pop()
            if scope:
                scope -= 1
            tag = row[TAG]
            open_count[tag] -= 1
            row[LAST] = count - 1
            row[T1] = text_len
            if tag in STRING_CONTAINERS:
                holders.pop()
                row[TEXT] = "".join(row[OWN])
            else:
                if row[KEPT] and text_len - row[T0] <= _SHORT_TEXT:
                    row[TEXT] = "".join(texts[row[OWN]:])
                if tag in PRESERVE_SPACE:
                    preserving -= 1
            if showing:
                showing -= 1
                if tag in markup_skip:
                    skipped -= 1
                elif not skipped and tag not in VOID_TAGS:
                    put("</" + tag + ">")
            row[H1] = shown_len
            # the string of an only child is handed up to its parent
            if stack and stack[-1][CHILDREN] == 1:
                stack[-1][SOLE] = row[SOLE]
            return tag

        def close_element(tag):
            if buffered:
                flush()
            if open_count.get(tag):
                while pop() != tag:
                    pass

        def flush():
            data = buffered[0] if len(buffered) == 1 else "".join(buffered)
            buffered.clear()
            if not preserving and not data.strip(ASCII_SPACE):
                data = "\n" if "\n" in data else " "
            kind = holders[-1][TAG] if holders else "text"
            if showing and kind not in _RAW_END:
                string(data, kind, _escape(data))
            else:
                string(data, kind, data)

        def string(data, kind, piece):
            nonlocal count, text_len, late
            start, shown_start = text_len, shown_len
            if showing and not skipped:
                put(piece)
            own = None
            if kind == "text":
                texts.append(data)
                text_len += len(data)
            else:
                own = data
                for holder in holders:
                    if holder[TAG] == kind:
                        holder[OWN].append(data)
            if stack:
                parent = stack[-1]
                parent[CHILDREN] += 1
                parent[SOLE] = count if parent[CHILDREN] == 1 else None
            if keep_all or (marked is not None and marked(data)):
                if kind == "text" and len(data) <= _SHORT_TEXT:
                    own = data
                out.append([count, count, stack[-1][PRE] if stack else -1, kind, None, None, None,
                            own, start, text_len, shown_start, shown_len, None])
                # rules look at a string's parent and at its only-child ancestors
                for row in reversed(stack):
                    if not row[KEPT]:
                        row[KEPT] = late = True
                        out.append(row)
                    if row[CHILDREN] != 1:
                        break
            count += 1

        def replay():
            for what, value, extra in events:
                if what == "text":
                    if value:
                        buffered.append(value)
                elif what == "open" or what == "single":
                    open_element(*self._opening(value, extra, what == "single"))
                elif what == "close":
                    close_element(value)
                else:
                    if buffered:
                        flush()
                    string(value, "comment" if what == "comment" else "text", extra)
            events.clear()

        self.reset()
        self.rawdata = html
        self._last_close = html.rfind(">")
        self._last_comment = max(html.rfind("-->"), html.rfind("--!>"))
        find, plain_tag = html.find, self._plain_tag
        at, size = 0, len(html)
        while at < size:
            bracket = find("<", at)
            if bracket < 0:
                bracket = size
            if bracket > at:
                data = html[at:bracket]
                buffered.append(unescape(data) if "&" in data else data)
                if bracket == size:
                    break
            raw = None
            at = find(">", bracket, bracket + _TAG_MAX) + 1
            meaning = tags.get(html[bracket:at]) if at else None
            if meaning is None:
                found = plain_tag(html, bracket)
                if found is not None:
                    meaning, at = found
            if meaning is None:
                at = self._odd(html, bracket)
                replay()
                raw = self.cdata_elem
                if raw:
                    self.clear_cdata_mode()
            elif len(meaning) == 1:
                close_element(meaning[0])
            else:
                open_element(*meaning)
                if meaning[0] in _RAW_END and not meaning[-1]:
                    raw = meaning[0]
            if raw:  # script and style: no markup up to their own end tag
                match = _RAW_END[raw].search(html, at)
                if match is None:  # never closed: the rest of the page is its string
                    if at < size:
                        buffered.append(html[at:])
                    break
                if match.start() > at:
                    buffered.append(html[at : match.start()])
                close_element(raw)
                at = match.end()
        if buffered:
            flush()
        while stack:
            pop()
        if late:
            out.sort(key=lambda row: row[PRE])
        hits = self.no_hits()
        if hits:
            for place, row in enumerate(out):
                if len(row) > NODE_WIDTH:
                    for number in row[HITS]:
                        hits[number].append(place)
        return PageTree("".join(texts) if self._with_text else "", "".join(shown), out, hits)


def _wants(keep, tag, cls, attrs):
    """Does the filter let this element through?"""
    if keep.everything or tag in keep.tags:
        return True
    if cls and (
        not keep.tokens.isdisjoint(cls.split())
        or cls[1:-1] in keep.exact_classes
        or any(part in cls for part in keep.class_parts)
    ):
        return True
    return any(
        (name, value) in keep.attr_values
        or (tag, name) in keep.attrs
        or (None, name) in keep.attrs
        or any(name == n and (value or "").startswith(head) for n, head in keep.attr_heads)
        for name, value in attrs
    )


def _attributes(section):
    pairs = []
    for name, double, single, bare in _ATTR.findall(section):
        value = double or single or bare
        pairs.append((name.lower(), unescape(value) if "&" in value else value))
    return pairs


def _start_markup(tag, attrs, cls, allowed):
    values = {}
    for name, value in attrs:
        if name in allowed:
            values[name] = cls[1:-1] if name == "class" else (value or "")
    # attributes come out in alphabetical order
    parts = [f" {name}={_quote(_escape(values[name]))}" for name in sorted(values)]
    return "<" + tag + "".join(parts) + ("/>" if tag in VOID_TAGS else ">")


def _escape(text: str) -> str:
    if "&" in text:
        text = text.replace("&", "&amp;")
    if "<" in text:
        text = text.replace("<", "&lt;")
    if ">" in text:
        text = text.replace(">", "&gt;")
    return text


def _quote(value: str) -> str:
    if '"' not in value:
        return '"' + value + '"'
    if "'" not in value:
        return "'" + value + "'"
    return '"' + value.replace('"', "&quot;") + '"'

"""Secret scanning with a worklist of decoded layers."""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Callable, Generator, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from ledgerloom.llm.common import id_text

# The contract's patterns, in the order of its kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex")

URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
#: Base64 over single line breaks, those escaped in strings included, with blanks around them.
BREAK = r"[\x20\t]{0,64}(?:\r\n|\n|\r|\\r\\n|\\n)[\x20\t]{0,64}"
SIGN = "[A-Za-z0-9+/_-]"
BASE64 = re.compile(rf"(?<!{SIGN})(?:{SIGN}{{16,}}+|{SIGN}++(?={BREAK}{SIGN}))(?:{BREAK}{SIGN}++)*+={{0,2}}")
LINE = re.compile(rf"{SIGN}+")
BROKEN = re.compile(BREAK)
RUN = re.compile(rf"{SIGN}++(?:{BREAK}{SIGN}++)*+")
#: A run that may go on after the end of a piece.
OPEN = re.compile(rf"(?<!{SIGN})({SIGN}++(?:{BREAK}{SIGN}++)*+)[\x20\t]{{0,64}}(?:(?:\r\n?|\n|\\(?:r(?:\\n?)?|n)?)[\x20\t]{{0,64}})?\Z")
SPACES = re.compile("\x20{2,}")
ENOUGH = re.compile(rb"[\t\r\n\x20-\x7e]{16}")
MAGIC = (b"\x1f\x8b", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd")
#: Where compressed bytes may begin: gzip, bzip2, xz, Zstandard, and headers of zlib without a dictionary.
ZLIB = [bytes([m, f]) for m in range(8, 128, 16) for f in range(256) if (m << 8 | f) % 31 == 0 and not f & 32]
PACKED = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|" + b"|".join(map(re.escape, ZLIB)), re.S)
#: What decompressors raise for damaged data.
DAMAGED = (zlib.error, OSError, lzma.LZMAError, zstandard.ZstdError)


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of each secret of one layer."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12] if ":" in text or "=" in text else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]


def unescape_url(m: re.Match) -> list[tuple[str, int, int]]:
    """Characters of a run of %XX, each with where it begins and ends in the run."""
    raw = bytes.fromhex(m[0].replace("%", ""))
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append((raw[i : i + n].decode(), i * 3, (i + n) * 3))
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(("\ufffd", i * 3, i * 3 + 3))
            i += 1
    return out


def code_of(m: re.Match) -> int:
    return int(m[6]) if m[6] else int(next(x for x in m.groups() if x), 16)


def unescape_unicode(m: re.Match) -> list[tuple[str, int, int]]:
    code = code_of(m)
    return [(chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd", 0, len(m[0]))]


def replaced(text: str, pattern: re.Pattern, decode) -> tuple[str, np.ndarray, np.ndarray] | None:
    """The text with all matches decoded, and where each new character begins and ends in the old text."""
    pieces, starts, ends, pos = [], [], [], 0
    for m in pattern.finditer(text):
        plain = np.arange(pos, m.start())
        new = decode(m)
        pieces += [text[pos : m.start()], "".join(c for c, _, _ in new)]
        starts += [plain, np.array([m.start() + a for _, a, _ in new], np.int64)]
        ends += [plain + 1, np.array([m.start() + b for _, _, b in new], np.int64)]
        pos = m.end()
    if not pos:
        return None
    plain = np.arange(pos, len(text))
    return "".join([*pieces, text[pos:]]), np.concatenate([*starts, plain]), np.concatenate([*ends, plain + 1])


class Inflate:
    """zlib and gzip with the methods of the other decompressors."""

    def __init__(self, bits: int):
        self.inner, self.needs_input = zlib.decompressobj(bits), True

    def decompress(self, data: bytes, most: int) -> bytes:
        out = self.inner.decompress(self.inner.unconsumed_tail + data, most)
        self.needs_input = not self.inner.unconsumed_tail and len(out) < most
        return out

    eof = property(lambda self: self.inner.eof)
    unused_data = property(lambda self: self.inner.unused_data)


class Zstandard:
    needs_input = True

    def __init__(self):
        self.inner = zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj()  # the largest that is ever written

    def decompress(self, data: bytes, most: int) -> bytes:
        return self.inner.decompress(data)

    eof = property(lambda self: self.inner.eof)
    unused_data = property(lambda self: self.inner.unused_data)


def opener(head: bytes):
    """(decompressor, bytes to feed at once) for a member that begins so."""
    if head[:2] == MAGIC[0]:
        return Inflate(31), 1 << 16
    if head[:3] == MAGIC[1]:
        return bz2.BZ2Decompressor(), 1 << 16
    if head[:6] == MAGIC[2]:
        return lzma.LZMADecompressor(), 1 << 16
    if head[:4] == MAGIC[3]:
        return Zstandard(), 512  # at most 16 MB come of them
    return Inflate(15), 1 << 16


class Again:
    """Pieces of bytes that can be read more than once."""

    def __init__(self, begin: Callable[[], Iterator[bytes]]):
        self.begin = begin

    def __iter__(self) -> Iterator[bytes]:
        return self.begin()


class Member:
    """The contents of the compressed member that pieces of bytes begin with, piece by piece.

    When they end, state is whole, cut or broken, and size that of a whole member, or what was read of it.
    A broken one gives all that comes before the damage (of a bzip2 block with a wrong checksum all but the last byte);
    for that its pieces are read again.
    Only what a decompressor says of its data is damage. Errors of the pieces and want of memory are raised.
    """

    def __init__(self, data: Iterable[bytes]):
        self.data, self.state, self.size = data, "open", 0

    def __iter__(self) -> Iterator[bytes]:
        given = 0
        for out in self.unpacked(1 << 16):
            given += len(out)
            yield out
        for most in (1 << 8, 1):
            if self.state == "broken" and (rest := b"".join(self.unpacked(most, self.size, given))):
                given += len(rest)
                yield rest

    def unpacked(self, most: int, good: int = 0, given: int = 0) -> Iterator[bytes]:
        """What comes after the given bytes; once the good bytes are read, at most so many are fed and taken at once."""
        source, head, got = iter(self.data), b"", 0
        self.size = 0
        while len(head) < 6 and (x := next(source, None)) is not None:
            head += x
        d, step = opener(head)
        for x in chain([head], source):
            i = 0
            while i < len(x):
                part = x[i : i + min(step, most if self.size >= good else good - self.size)]
                fed = len(part)
                while True:
                    try:
                        out = d.decompress(part, min(max(given - got, most), 1 << 16) if self.size >= good else 1 << 16)
                    except DAMAGED as e:
                        if "Allocation error" in str(e) or str(e).startswith("Error -4 "):
                            raise MemoryError(str(e)) from e
                        self.state = "broken"
                        return
                    if new := out[max(given - got, 0) :]:
                        yield new
                    got += len(out)
                    if d.eof:
                        self.size += fed - len(d.unused_data)
                        self.state = "whole"
                        return
                    if d.needs_input:
                        break
                    part = b""
                self.size += fed
                i += fed
        self.state = "cut"


def slices(raw: bytes, start: int) -> Again:
    return Again(lambda: (raw[i : i + (1 << 16)] for i in range(start, len(raw), 1 << 16)))


def left_off(member: Member, raw: bytes, at: int) -> bool:
    """Whether a member was not read to its end. Headers of zlib are too short to tell a member from chance."""
    return member.state != "whole" and raw.startswith(MAGIC, at)


def members(raw: bytes, start: int, stop: int) -> Iterator[tuple[int, Member, bool]]:
    """(place, member, whether it holds anything) of all compressed members that begin from start to stop; each is read to its end."""
    while (m := PACKED.search(raw, start)) and m.start() < stop:
        member = Member(slices(raw, m.start()))
        some = sum(map(len, member)) > 0
        yield m.start(), member, some
        start = m.start() + member.size if member.state == "whole" else m.start() + 1


def kinds_in(raw: bytes, at: int, most: int) -> tuple[set[int], bool]:
    """Kinds of secrets in the member that begins at a place and in all that it holds, and whether no other can be in what was not read."""
    kinds: set[int] = set()
    return kinds, kinds_of(lambda: iter(Member(slices(raw, at))), kinds, most)


def watched(member: Member, unread: list[int], at: int) -> Iterator[bytes]:
    yield from member
    if member.state != "whole":
        unread.append(at)


def gathered(pieces: Iterator[bytes], most: int) -> Iterator[tuple[bytes, bool]]:
    """Pieces of at least `most` bytes, and whether it is the last."""
    held, size = [], 0
    for x in pieces:
        if size >= most:
            yield b"".join(held), False
            held, size = [], 0
        held.append(x)
        size += len(x)
    yield b"".join(held), True


def beyond(pieces: Iterator[bytes], skip: int) -> Iterator[bytes]:
    for x in pieces:
        if skip < len(x):
            yield x[skip:]
        skip = max(skip - len(x), 0)


def unescaped(pieces: Iterator[bytes], pattern: re.Pattern, decode) -> Iterator[bytes]:
    held = ""
    for x in pieces:
        text = held + x.decode("latin-1")
        cut = max(text.rfind(c, max(len(text) - 12, 0)) for c in "%\\&")  # an escape may go on
        held = text[cut:] if cut >= 0 else ""
        yield pattern.sub(decode, text[:cut] if cut >= 0 else text).encode("latin-1")
    yield pattern.sub(decode, held).encode("latin-1")


def url_byte(m: re.Match) -> str:
    return bytes.fromhex(m[0].replace("%", "")).decode("latin-1")


def one_byte(m: re.Match) -> str:
    return chr(min(code_of(m), 255))


def base64_bytes(body: str) -> bytes:
    body = body.replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        body = body[:-1]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def unbase64(pieces: Iterator[bytes], skip: int) -> Iterator[bytes]:
    """The bytes of the base64 run that pieces begin with, without its first characters."""
    held, body = "", ""
    for x in pieces:
        text = held + x.decode("latin-1")
        m = OPEN.match(text)
        run = m or RUN.match(text)
        if run is None:
            break
        end = run.end(1) - 1 if m else run.end()
        held = text[end:]
        body += "".join(BROKEN.split(text[:end]))
        gone = min(skip, len(body))
        body, skip = body[gone:], skip - gone
        yield base64_bytes(body[: len(body) // 4 * 4])
        body = body[len(body) // 4 * 4 :]
        if not m:
            held = ""
            break
    yield base64_bytes((body + "".join(LINE.findall(held)[:1]))[skip:])


def kinds_of(stream: Callable[[], Iterator[bytes]], kinds: set[int], most: int) -> bool:
    """Adds the kinds of secrets in a stream of bytes and in all that is encoded in it.

    False if a compressed member in it could not be read to its end and kinds are missing that may be there.

    A worklist holds streams, of any number of layers on one another; all share a set of digests, so that
    what has been read once is not unpacked again, be it by a cycle or by a repeat.
    """
    seen: set[bytes] = set()
    unread: list[int] = []
    todo = [below(stream, kinds, most, seen, unread)]
    while todo and len(kinds) < len(KINDS):
        try:
            todo.append(below(next(todo[-1]), kinds, most, seen, unread))
        except StopIteration as end:
            todo.pop()
            todo += [below(x, kinds, most, seen, unread) for x in reversed(end.value or [])]
    return len(kinds) == len(KINDS) or not unread


def below(stream: Callable[[], Iterator[bytes]], kinds: set[int], most: int, seen: set[bytes], unread: list[int]) -> Generator[Callable[[], Iterator[bytes]], None, list[Callable[[], Iterator[bytes]]] | None]:
    """Adds the kinds in a stream itself, and members that cannot be read to their end; yields and returns the streams one layer below it.

    The stream is read in overlapping pieces of about `most` bytes and begun anew
    for each layer that does not fit a piece, so it can be of any length. What lies in the last
    piece is returned, so that of a chain of layers only one is held.
    """
    digest, before, tail, base, done, going = hashlib.sha256(), "", b"", 0, 0, None
    url = unicode = False
    runs, packed = [], []
    for piece, last in gathered(stream(), most):
        if len(kinds) == len(KINDS):
            return
        digest.update(piece)
        so_far = digest.digest() + bytes([last])
        new = so_far not in seen
        seen.add(so_far)
        own: list[Callable[[], Iterator[bytes]]] = []
        near = SPACES.sub(" ", before + piece.decode("latin-1"))
        kinds.update(k for _, k, _ in scan(near))
        before = near[-64:]
        raw = tail + piece
        text = raw.decode("latin-1")
        url = url or "%" in text and URL.search(text) is not None
        unicode = unicode or ("\\" in text or "&#" in text) and UNICODE.search(text) is not None
        first = 0
        if going is not None and (m := RUN.match(text, going)):
            first = m.end()
        open_ = None if last else OPEN.search(text)
        cut, again = len(text), None
        if open_:
            if going is not None and open_.start() < first:
                again = open_.end(1) - 1
            elif len(text) - open_.start() >= most:
                runs.append(base + open_.start())
                again = open_.end(1) - 1
            cut = open_.start()
        for m in BASE64.finditer(text, first):
            if m.start() >= cut:
                break
            body = "".join(BROKEN.split(m[0].rstrip("=")))
            for skip in range(4):
                inner = base64_bytes(body[skip:])
                if ENOUGH.search(inner) or PACKED.search(inner):
                    own.append(lambda inner=inner: iter([inner]))
        stop = len(raw) if last else len(raw) - 16
        reach = max(done - base, 0)
        for at, member, some in members(raw, reach, stop):
            if some:
                own.append(lambda raw=raw, at=at: iter(Member(slices(raw, at))))
            if member.state == "cut" and not last:
                packed.append((base + at, raw.startswith(MAGIC, at)))
            elif left_off(member, raw, at):
                unread.append(base + at)
            reach = at + member.size if member.state == "whole" else reach
        if new and not last:
            yield from own
        done = base + max(stop, reach)
        keep = max(min(len(raw) - 64, cut if again is None else again), 0)
        going = None if again is None else again - keep
        base, tail = base + keep, raw[keep:]
    if not new:
        return None
    for at, named in packed:
        member = lambda at=at: Member(Again(lambda: beyond(stream(), at)))
        own.append((lambda member=member, at=at: watched(member(), unread, at)) if named else lambda member=member: iter(member()))
    own += [lambda at=at, skip=skip: unbase64(beyond(stream(), at), skip) for at in runs for skip in range(4)]
    return own + [lambda: unescaped(stream(), URL, url_byte)] * url + [lambda: unescaped(stream(), UNICODE, one_byte)] * unicode


def layer(raw: bytes) -> str | None:
    """Bytes as a text of as many characters, None if nothing can be found in it.

    All patterns and escapes are ASCII, so bytes beyond it, valid UTF-8 or not, break
    a match alike. What matches, here or decoded further, has 16 such characters on end.
    """
    return raw.decode("latin-1") if ENOUGH.search(raw) else None


def from_base64(body: str, at: np.ndarray, end: int, most: int) -> tuple[list[tuple[str, np.ndarray, np.ndarray]], list[tuple[int, int, int]], list[tuple[int, bool]]]:
    """What base64 characters hold from the first of them: bytes by groups of four, secrets of what was compressed, and places of members with whether they were read.

    at: the place of each character; end: where the run ends.
    """
    raw = base64_bytes(body)
    spans, reads = [], []
    for start, member, some in members(raw, 0, len(raw)):  # something may stand before it
        place = int(at[start * 4 // 3])
        kinds, all_ = kinds_in(raw, start, most) if some else (set(), True)
        spans += [(place, k, end) for k in kinds]
        reads.append((place, all_ and not left_off(member, raw, start)))
    text = layer(raw)
    if text is None:
        return [], spans, reads
    last = np.arange(1, len(raw) + 1)
    return [(text, at[(last - 1) * 4 // 3], at[-(-last * 4 // 3) - 1] + 1)], spans, reads


def base64_layers(text: str, most: int) -> tuple[list[tuple[str, np.ndarray, np.ndarray]], list[tuple[int, int, int]], list[tuple[int, bool]]]:
    """The layers, compressed secrets and members of all base64 runs, from each of the four places a group may begin at, and of their single lines."""
    out, spans, reads = [], [], []

    def add(*run):
        layers, found, members_read = from_base64(*run, most)
        out.extend(layers)
        spans.extend(found)
        reads.extend(members_read)

    for m in BASE64.finditer(text):
        if m.end() - m.start() < 16:
            continue
        body = m[0].rstrip("=")
        breaks = list(BROKEN.finditer(body)) if len(body) > 1 and not LINE.fullmatch(body) else []
        at = np.arange(m.start(), m.start() + len(body))
        if breaks:
            edges = [0, *(x for k in breaks for x in k.span()), len(body)]
            lines = list(zip(edges[::2], edges[1::2]))
            for a, b in lines:
                if b - a >= 16:
                    add(body[a:b], at[a:b], m.start() + b)
            at = np.concatenate([at[a:b] for a, b in lines])
            body = "".join([body[a:b] for a, b in lines])
        for skip in range(4):
            if len(body) - skip >= 16:
                add(body[skip:], at[skip:], m.end())
    return out, spans, reads


def escaped_members(text: str, pattern: re.Pattern, decode: Callable[[re.Match], list[int]], most: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, bool]]]:
    """Secrets of compressed members whose bytes are written as escapes, or as escapes and plain signs, and places of those with whether they were read.

    A span goes from a member's first byte to its last, or to the end of the text if it breaks off.
    """
    values, starts, ends, pos, known = [], [], [], 0, []
    for m in pattern.finditer(text):
        plain = np.arange(pos, m.start())
        codes = decode(m)
        step = (m.end() - m.start()) // len(codes)
        values += [text[pos : m.start()].encode("latin-1", "replace"), bytes(c if c < 256 else 63 for c in codes)]
        at = m.start() + step * np.arange(len(codes))
        starts += [plain, at]
        ends += [plain + 1, np.append(at[1:], m.end())]
        known += [np.zeros(len(plain), bool), np.ones(len(codes), bool)]
        pos = m.end()
    if not values:
        return [], []
    plain = np.arange(pos, len(text))
    raw = b"".join([*values, text[pos:].encode("latin-1", "replace")])
    starts, ends = np.concatenate([*starts, plain]), np.concatenate([*ends, plain + 1])
    known = np.concatenate([*known, np.zeros(len(plain), bool)])
    out, reads = [], []
    for at, member, some in members(raw, 0, len(raw)):
        if known[at : at + member.size].any():
            last = at + member.size if member.state == "whole" else len(raw)
            kinds, all_ = kinds_in(raw, at, most) if some else (set(), True)
            out += [(int(starts[at]), k, int(ends[last - 1])) for k in kinds]
            reads.append((int(starts[at]), all_ and not left_off(member, raw, at)))
    return out, reads


def decoded(text: str, most: int) -> tuple[list[tuple[str, np.ndarray, np.ndarray]], list[tuple[int, int, int]], list[tuple[int, bool]]]:
    """The layers one step below a text, the secrets of what is compressed in it, and places of compressed members with whether they were read."""
    out, spans, reads = [], [], []
    if "%" in text and (x := replaced(text, URL, unescape_url)):
        out.append(x)
        found = escaped_members(text, URL, lambda m: list(bytes.fromhex(m[0].replace("%", ""))), most)
        spans, reads = spans + found[0], reads + found[1]
    if ("\\" in text or "&#" in text) and (x := replaced(text, UNICODE, unescape_unicode)):
        out.append(x)
        found = escaped_members(text, UNICODE, lambda m: [code_of(m)], most)
        spans, reads = spans + found[0], reads + found[1]
    layers, *found = base64_layers(text, most)
    return out + layers, spans + found[0], reads + found[1]


def secrets_of(text: str, most: int = 16 << 20) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(spans of the text itself, spans of it and all decoded layers), each sorted as (start, kind, end)."""
    return examined(text, most)[:2]


def examined(text: str, most: int = 16 << 20) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], list[int]]:
    """What secrets_of gives, and the places of compressed members that in no layer could be read to their end, so that kinds may be missing there."""
    base = sorted(scan(text))
    spans, seen, todo, read = set(base), {text}, deque([(text, None, None)]), (set(), set())
    while todo:
        layer, a, b = todo.popleft()
        layers, packed, reads = decoded(layer, most)
        for s, all_ in reads:
            read[all_].add(s if a is None else int(a[s]))
        spans |= {(s, k, e) if a is None else (int(a[s]), k, int(b[e - 1])) for s, k, e in packed}
        for new, x, y in layers:
            if a is not None:
                x, y = a[x], b[y - 1]
            key = hashlib.sha256(new.encode("utf-8", "surrogatepass") + b"%d:%d" % (x[0], y[-1]) if len(x) else b"").digest()
            if new and new not in seen and key not in seen:
                seen.add(key)
                spans |= {(int(x[s]), kind, int(y[s:e].max())) for s, kind, e in scan(new)}
                todo.append((new, x, y))
    return base, sorted(spans), sorted(read[False] - read[True])


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", layer_bytes: int = 16 << 20) -> DataFrame:
    """Secrets of each whole text and of what is encoded in it.

    A worklist holds layers; each is scanned and decoded one step (URL escapes,
    Unicode and numeric escapes, base64 runs, compressed runs inside base64), and
    what comes out joins the list unless that text was seen at that place, until
    nothing new comes. Each layer keeps for every character where it begins and
    ends in the text above, so spans point into the document. A span found in a
    compressed layer is that of the run from where it begins. Compressed members are
    read to their end, one after another, in pieces of about layer_bytes, so only
    the kinds that occur in them are held.

    Compressed members are found in base64 and in URL, Unicode and `\\x` escapes. Of one that is damaged or cut, what comes
    before that is scanned. n_unread counts the places of those (gzip, bzip2, xz, Zstandard, also inside others) with no other
    reading to an end, where kinds of secrets may be missing: no span there is not known to be none. Zstandard frames that need
    a dictionary are among them. A lost package or want of memory is an error, never a result. Frames of Zstandard with
    windows up to 2 GB are read; such a window takes as much memory.

    Null and empty texts: no spans. Very long texts, and layers of any depth: scanned whole, each text with its
    layers alone. Repeated rows: each scanned alone. Equal
    spans of several layers: one; spans of equal starts go in the order of their kinds
    and ends. Null ids stay. An empty table: no rows. Other columns are ignored.

    Returns id_col, n_assign, n_access, n_hex, base_sha256, spans, n_decoded, n_unread.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = id_text(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            rows = []
            for x in b.column("text"):
                base, spans, unread = examined(x.as_py() or "", layer_bytes)
                n = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans) - len(set(base)), len(unread)))
            cols = list(zip(*rows)) or [[]] * 7
            yield pa.record_batch([b.column("id"), *(pa.array(c, pa.string() if i in (3, 4) else pa.int64()) for i, c in enumerate(cols))], names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_decoded", "n_unread"])

    return keyed.mapInArrow(run, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_decoded long, n_unread long").withColumnRenamed("id", id_col)

"""Secret scan: patterns, and structural confirmation of encoded candidates.

Base kinds are plain patterns (assignments, access key ids, hex runs). Base64 and hex candidates are decoded besides, and reported under
a kind of their own only if their structure holds: DER key encodings whose nested lengths add up, OpenSSH containers and public keys with consistent
length fields, PEM armour around such a body, and signed tokens whose header decodes to JSON with an algorithm.

Every run of an alphabet is decoded once per alignment, and a bounded number of length fields is read at every place that can begin a key,
so that the time is linear in a text's length whatever it holds; very long texts are scanned whole.

Spans are code points, end exclusive. Defined results: null and empty texts have no spans. Each input row gives one row; repeated rows repeat their
result. Only the text is read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import itertools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from deltaloom.llm.text import octets

#: Base patterns and the least lengths of what they must match (fixed values).
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

#: Order of kinds among spans with one start.
KINDS = ("assign", "access", "hex", "pem_key", "der_key", "ssh_key", "signed_token")

_WORDS = (b"passw", b"secret", b"token", b"api")
_ARMOUR = re.compile(rb"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----([^-]*(?:-(?!----)[^-]*)*)-----END \1-----")
_HEADER = re.compile(rb"(?:^|(?<=[\r\n]))[ \t]*+[A-Za-z][A-Za-z0-9-]*+:[^\r\n]*+(?:\r?\n[ \t]++[^\r\n:]*+:[^\r\n]*+)*+")
#: A line end, as it is or escaped, with indentation and quoting marks of the next line.
_BREAK = re.compile(rb"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t>#*|]*")
#: What can begin a DER sequence (30 xx), the length field of an SSH key type (00 00 00 xx) or an OpenSSH container.
_BASE64 = re.compile(rb"M[A-P][A-Za-z0-9+/]|AAAA[B-Q]|b3Bl")
_HEX_DER = re.compile(rb"(?<![0-9A-Fa-f])(?:30|000000|6[Ff]70656[Ee])[0-9A-Fa-f]")
_LINE64, _LINE_HEX = re.compile(rb"[A-Za-z0-9+/]+"), re.compile(rb"[0-9A-Fa-f]+")
_PAD = re.compile(rb"={1,2}")
#: The first part of a dotted token, a whole run of its characters, with what stands behind it.
_TOKEN = re.compile(rb"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]++)(?=\.([A-Za-z0-9_-]{4,}+)\.([A-Za-z0-9_-]*+))")


def _elements(data: bytes, at: int, end: int, most: int) -> list[tuple[int, int, int]] | None:
    """Tag, content start and end of at most ``most`` consecutive DER elements that fill [at, end) exactly, else None."""
    out = []
    while at < end:
        if at + 2 > end or len(out) == most:
            return None
        tag, size, head = data[at], data[at + 1], 2
        if size & 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + 2 + more > end:
                return None
            size, head = int.from_bytes(data[at + 2 : at + 2 + more], "big"), 2 + more
            if size < 0x80:
                return None
        if at + head + size > end:
            return None
        out.append((tag, at + head, at + head + size))
        at += head + size
    return out


#: Elements of the longest key, a PKCS #1 private key with further primes, and of an algorithm.
_KEY_ELEMENTS, _ALGORITHM_ELEMENTS = 10, 4


def der_key(data: bytes, at: int = 0, end: int | None = None) -> bool:
    """Whether [at, end) is one DER private or public key: PKCS #1, PKCS #8 plain or encrypted, SEC 1, DSA or SubjectPublicKeyInfo.

    Reads a bounded number of element heads, however long the data.
    """
    top = _elements(data, at, len(data) if end is None else end, 1)
    if not top or top[0][0] != 0x30:
        return False
    inner = _elements(data, top[0][1], top[0][2], _KEY_ELEMENTS)
    if not inner:
        return False
    tags, sizes = [t for t, _, _ in inner], [b - a for _, a, b in inner]
    first = data[inner[0][1] : inner[0][1] + min(sizes[0], 2)]

    def algorithm(element: tuple[int, int, int]) -> bool:
        parts = _elements(data, element[1], element[2], _ALGORITHM_ELEMENTS)
        return bool(parts) and parts[0][0] == 0x06

    if len(tags) >= 9 and set(tags[:9]) == {0x02}:  # version and eight numbers
        return True
    if tags[:3] == [0x02, 0x30, 0x04]:  # version, algorithm, key
        return algorithm(inner[1])
    if tags[:2] == [0x02, 0x04] and first == b"\x01":  # elliptic curve
        return sizes[1] >= 16
    if tags == [0x02] * 6 and first == b"\0":  # DSA: version, p, q, g, y, x
        return sizes[1] >= 48
    if tags == [0x02, 0x02]:  # modulus and exponent
        return sizes[0] >= 64 and sizes[1] <= 8 and bool(data[inner[1][2] - 1] & 1)
    return tags in ([0x30, 0x03], [0x30, 0x04]) and algorithm(inner[0])  # algorithm, and public key bits or an encrypted private key


#: Fields of a public key by its type; other types have at most so many.
_SSH_FIELDS = {b"ssh-rsa": 3, b"ssh-dss": 5, b"ssh-ed25519": 2, b"ssh-ed448": 2, b"sk-ssh-ed25519@openssh.com": 3, b"sk-ecdsa-sha2-nistp256@openssh.com": 4}
_OTHER_FIELDS, _TYPE_CHARS, _CONTAINED = 16, 64, 64
_MAGIC = b"openssh-key-v1\0"
_TYPE = re.compile(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+")


def _fields(data: bytes, at: int, end: int, count: int) -> list[tuple[int, int]]:
    """Places of up to ``count`` fields, each after its length in four bytes, that lie within [at, end)."""
    out: list[tuple[int, int]] = []
    while len(out) < count and at + 4 <= end:
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > end:
            break
        out.append((at + 4, at + 4 + size))
        at += 4 + size
    return out


def _ssh_size(data: bytes, at: int, line_end: int) -> int:
    """Bytes of the SSH key that begins at a place, 0 if there is none. Keys of other types than the listed ones end where their line does."""
    if data.startswith(_MAGIC, at):
        begin = at + len(_MAGIC)
        names = _fields(data, begin, len(data), 3)  # cipher, key derivation, its options; then the number of keys
        if len(names) < 3:
            return 0
        keys = int.from_bytes(data[names[2][1] : names[2][1] + 4], "big")
        if not 1 <= keys <= _CONTAINED:
            return 0
        parts = _fields(data, names[2][1] + 4, len(data), keys + 1)  # public parts and the private section
        return parts[-1][1] - at if len(parts) == keys + 1 else 0
    first = _fields(data, at, len(data), 1)
    if not first or not 4 < first[0][1] - first[0][0] <= _TYPE_CHARS:
        return 0
    name = data[first[0][0] : first[0][1]]
    if not _TYPE.fullmatch(name):
        return 0
    count = _SSH_FIELDS.get(name, 3 if name.startswith(b"ecdsa-sha2-") else 0)
    if count:
        fields = _fields(data, at, len(data), count)
        return fields[-1][1] - at if len(fields) == count else 0
    fields = _fields(data, at, line_end, _OTHER_FIELDS)
    return line_end - at if len(fields) >= 2 and fields[-1][1] == line_end else 0


def ssh_key(data: bytes) -> bool:
    """Whether bytes are one OpenSSH private key container, some padding behind it, or one public key with consistent length fields."""
    size = _ssh_size(data, 0, len(data))
    return size == len(data) or size > 0 and data.startswith(_MAGIC)


def _key_at(data: bytes, at: int, line_end: int) -> tuple[int, str] | None:
    """Bytes and kind of the key that begins at a place, if one does. The structure alone decides how far it goes."""
    head = data[at : at + 12]
    if head[:1] == b"\x30" and len(head) == 12:
        more = head[1] & 0x7F if head[1] & 0x80 else 0
        if more > 4 or head[1] == 0x80 or head[2 + more] not in (0x30, 0x02):
            return None
        size = 2 + more + (int.from_bytes(head[2 : 2 + more], "big") if more else head[1])
        return (size, "der_key") if at + size <= len(data) and der_key(data, at, at + size) else None
    size = _ssh_size(data, at, line_end) if head[:3] in (b"\0\0\0", _MAGIC[:3]) else 0
    return (size, "ssh_key") if size else None


class _Run:
    """Lines of one alphabet that follow each other, joined; decoded once for each alignment, however many places in it may begin a key."""

    def __init__(self, raw: bytes, at: int, line: re.Pattern):
        self.places, parts = [], []
        while (m := line.match(raw, at)) is not None:
            self.places.append(m.span())
            parts.append(m[0])
            gap = _BREAK.match(raw, m.end())
            if gap is None:
                break
            at = gap.end()
        self.text, self.end = b"".join(parts), self.places[-1][1]
        self.starts = [a for a, _ in self.places]
        self.before = [0, *itertools.accumulate(map(len, parts))]
        self.bits = 6 if line is _LINE64 else 4
        self.unit = 4 if line is _LINE64 else 2  # characters that make whole bytes
        self.decoded: dict[int, bytes] = {}

    def key(self, raw: bytes, place: int) -> tuple[int, str] | None:
        """End and kind of the key whose encoding begins at a place."""
        nth = bisect.bisect_right(self.starts, place) - 1
        char = self.before[nth] + place - self.starts[nth]
        if len(self.text) - char < 16:
            return None
        shift = char % self.unit
        if shift not in self.decoded:
            self.decoded[shift] = _decode64(self.text[shift:]) if self.unit == 4 else _from_hex(self.text[shift:])
        at = (char - shift) * self.bits // 8
        line_end = at + (self.before[nth + 1] - char) * self.bits // 8
        found = _key_at(self.decoded[shift], at, min(line_end, len(self.decoded[shift])))
        if found is None:
            return None
        last = char + -(-found[0] * 8 // self.bits)  # behind the last character
        nth = bisect.bisect_left(self.before, last) - 1
        end = self.starts[nth] + last - self.before[nth]
        pad = _PAD.match(raw, end) if self.unit == 4 else None
        return pad.end() if pad else end, found[1]


def _keys(raw: bytes, pattern: re.Pattern, line: re.Pattern, hidden: list[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
    """Keys in one encoding outside the ``hidden`` places, in the order of the text."""
    run, upto, inside = None, 0, 0
    for place in _places(pattern, raw):
        while inside < len(hidden) and hidden[inside][1] <= place:
            inside += 1
        if place < upto or (inside < len(hidden) and hidden[inside][0] <= place):
            continue
        if run is None or place >= run.end:
            run = _Run(raw, place, line)
        if found := run.key(raw, place):
            upto = found[0]
            yield place, *found


def _armoured(text: bytes) -> bool:
    """Whether the inside of PEM armour, its line ends plain or escaped, is a key or has the headers and blocks of an encrypted one."""
    text = re.sub(rb"\\r|\\n", b"\n", text)
    headers = b"".join(_HEADER.findall(text))
    body = _decode64(re.sub(rb"[^A-Za-z0-9+/=]", b"", _HEADER.sub(b"", text)))
    if b"ENCRYPTED" in headers and b"DEK-Info" in headers:
        return len(body) >= 16 and len(body) % 8 == 0
    return der_key(body) or ssh_key(body)


def _decode64(text: bytes, urls: bool = False) -> bytes:
    text = re.sub(rb"\s", b"", text).rstrip(b"=")
    text = text[: len(text) - (len(text) % 4 == 1)]
    try:
        return base64.b64decode(text + b"=" * (-len(text) % 4), b"-_" if urls else None, validate=True)
    except (binascii.Error, ValueError):
        return b""


def signed_token(head: bytes, body: bytes) -> bool:
    """Whether the first part of a dotted token is a JSON header that names an algorithm, and the second is JSON too."""
    try:
        header = json.loads(_decode64(head, True))
        claims = json.loads(_decode64(body, True)) if isinstance(header, dict) and isinstance(header.get("alg"), str) else None
    except (ValueError, RecursionError):
        return False
    return isinstance(claims, dict)


def _tokens(raw: bytes) -> Iterator[tuple[int, int, str]]:
    """Signed tokens: in a run of token characters the first place that can begin a JSON header, with two more parts behind the run."""
    upto = 0
    for m in _TOKEN.finditer(raw):
        at = m[1].find(b"ey")
        if at >= 0 and len(m[1]) - at >= 12 and m.start() + at >= upto and signed_token(m[1][at:], m[2]):
            upto = m.end(3)
            yield m.start() + at, upto, "signed_token"


def _places(pattern: re.Pattern, raw: bytes) -> Iterator[int]:
    """Starts of all matches, overlapping ones too."""
    m = pattern.search(raw)
    while m:
        yield m.start()
        m = pattern.search(raw, m.start() + 1)


def find(raw: bytes) -> list[tuple[int, int, str]]:
    """All spans of one text in bytes: (start, end, kind), base kinds and confirmed structures."""
    out = []
    lower = raw.lower()
    if any(w in lower for w in _WORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(raw) if len(m[2]) >= LEAST_ASSIGN]
    if b"AKIA" in raw:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(raw) if len(m[0]) >= LEAST_ACCESS]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(raw)]
    armoured = []
    if b"-----BEGIN " in raw:
        for m in _ARMOUR.finditer(raw):
            if _armoured(m[2]):
                armoured.append((m.start(), m.end()))
                out.append((m.start(), m.end(), "pem_key"))
    for pattern, line in ((_BASE64, _LINE64), (_HEX_DER, _LINE_HEX)):
        out += _keys(raw, pattern, line, armoured)
    if b"ey" in raw and b"." in raw:
        out += _tokens(raw)
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _from_hex(text: bytes) -> bytes:
    return bytes.fromhex(text[: len(text) // 2 * 2].decode())


def spans(raw: bytes) -> list[tuple[int, int, str]]:
    """Spans of one text in code points."""
    found = find(raw)
    if not found or raw.isascii():
        return found
    edges, points, at, seen = sorted({e for s in found for e in s[:2]}), {}, 0, 0
    for edge in edges:
        seen, at = seen + len(raw[at:edge].decode("utf-8", "replace")), edge
        points[edge] = seen
    return [(points[a], points[b], kind) for a, b, kind in found]


_SPAN = pa.struct([("from_char", pa.int64()), ("to_char", pa.int64()), ("kind", pa.string())])


def _scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([[dict(zip(("from_char", "to_char", "kind"), s, strict=True)) for s in spans(x.as_py())] for x in batch], pa.list_(_SPAN))


def secrets(text: Column) -> Column:
    """Array of spans (from_char, to_char, kind) found in a text, by start, then kind."""
    return F.arrow_udf(_scan, "array<struct<from_char: long, to_char: long, kind: string>>").asNondeterministic()(octets(text))


def redact(raw: bytes, mark: bytes) -> bytes:
    """A text with all its spans, overlapping ones joined, replaced by a mark."""
    out, at, upto = [], 0, -1
    for start, end, _ in find(raw):
        if start < upto:
            upto = max(upto, end)
            continue
        if upto >= 0:
            out.append(mark)
            at = upto
        out.append(raw[at:start])
        upto = end
    return b"".join([*out, mark, raw[upto:]]) if upto >= 0 else raw


def redacted(text: Column, mark: str = "[secret]") -> Column:
    """The text without its secrets; null stays null."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([redact(x.as_py(), mark.encode()) for x in batch], pa.binary())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.when(text.isNotNull(), F.arrow_udf(run, "binary").asNondeterministic()(octets(text)).cast("string"))


def digest(found: Column) -> tuple[Column, Column]:
    """sha256 of the base spans' list, and the list of all spans, as ``kind:start:end`` joined by commas."""
    told = lambda s: F.concat_ws(":", s["kind"], s["from_char"], s["to_char"])
    base = F.transform(F.filter(found, lambda s: s["kind"].isin("assign", "access", "hex")), told)
    return F.sha2(F.array_join(base, ","), 256), F.array_join(F.transform(found, told), ",")


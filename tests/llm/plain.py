"""Plain-Python counterparts that share no code with the operators: a Feistel network, an attention GRU."""

import datetime as dt
import hashlib
import math

import regex

# -- pseudonyms --------------------------------------------------------------


def prf(key, tweak, i, half, mod):
    return int(hashlib.sha256("|".join([key, tweak, str(i), str(half)]).encode()).hexdigest()[:15], 16) % mod


def permuted(a, b, m, n, key, tweak):
    for i in range(10):
        if i % 2 == 0:
            a = (a + prf(key, tweak, i, b, m)) % m
        else:
            b = (b + prf(key, tweak, i, a, n)) % n
    return a, b


def digits_permuted(d, key, tweak):
    u = len(d) // 2
    v = len(d) - u
    a, b = permuted(int(d[:u]), int(d[u:]), 10 ** u, 10 ** v, key, f"{tweak}:{len(d)}")
    return f"{a:0{u}d}{b:0{v}d}"


def only_digits(s):
    return "".join(c for c in s if c in "0123456789")


def laid_out(form, digits):
    rest = iter(digits)
    return "".join(next(rest) if c in "0123456789" else c for c in form)


def luhn(payload):
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def mod97(s):
    return int("".join(str(ord(c) - 55) if c >= "A" else c for c in s)) % 97


def one(match, kind, key):
    """The pseudonym of a match, or None if it is no valid value of its kind."""
    d = only_digits(match)
    if kind == "email":
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in match)
        return "u" + hashlib.sha256(f"{key}|email|{low}".encode()).hexdigest()[:16] + match[match.index("@"):]
    if kind == "iban":
        account, country = match[4:], match[:2]
        if mod97((account + match[:4]).replace(" ", "")) != 1:
            return None
        a = only_digits(account)
        other = laid_out(account, digits_permuted(a, key, f"iban{country}")) if len(a) >= 2 else account
        return f"{country}{98 - mod97(other.replace(' ', '') + country + '00'):02d}{other}"
    if kind == "phone":
        m = regex.match(r"\+[0-9]{1,3}(?=[ .(-])", match)
        code = m[0] if m else ""
        rest = match[len(code):]
        r = only_digits(rest)
        return code + laid_out(rest, digits_permuted(r, key, f"phone{code}")) if 7 <= len(r) <= 15 else None
    if kind == "date":
        for mark, form in (("-", "%Y-%m-%d"), (".", "%d.%m.%Y"), ("/", "%d/%m/%Y")):
            if mark in match:
                try:
                    day = (dt.datetime.strptime(match, form).date() - dt.date(1800, 1, 1)).days
                except ValueError:
                    return None
                if not 0 <= day < 146_097:
                    return None
                a, b = permuted(day // 773, day % 773, 189, 773, key, "date")
                new = dt.date(1800, 1, 1) + dt.timedelta(days=a * 773 + b)
                y, m, q = f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"
                return {"-": f"{y}-{m}-{q}", ".": f"{q}.{m}.{y}", "/": f"{q}/{m}/{y}"}[mark]
    if kind == "ssn":
        area, group, serial = int(match[:3]), int(match[4:6]), int(match[7:])
        if not 0 < area < 900 or area == 666 or not group or not serial:
            return None
        a, b = permuted(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn")
        return f"{a + 1 + (a >= 665):03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"
    if kind == "ip":
        o = [int(x) for x in match.split(".")]
        if max(o) > 255:
            return None
        a, b = permuted(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip")
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if len(d) < 13 or luhn(d[:-1]) != d[-1]:
        return None
    payload = digits_permuted(d[:-1], key, "card")
    return laid_out(match, payload + luhn(payload))


def pseudonymize(text, patterns, key):
    """(text with pseudonyms, [(kind, pseudonym)]); patterns: {kind: pattern}, tried in order."""
    if text is None:
        return None, []
    found, out, at = [], [], 0
    order = ["iban", "phone", "date", "ssn", "ip", "card"]
    for m in regex.finditer("|".join(f"(?:{p})" for p in patterns.values()), text):
        s = m[0]
        kind = "email" if "@" in s else next(k for k in order if k == "card" or regex.fullmatch(patterns[k], s))
        new = one(s, kind, key)
        if new is not None:
            found.append((kind, new))
        out += [text[at:m.start()], s if new is None else new]
        at = m.end()
    return "".join(out) + text[at:], found


# -- attention GRU -------------------------------------------------------------


def dot(x, columns):
    """A row vector times a matrix given by rows."""
    return [sum(a * row[k] for a, row in zip(x, columns)) for k in range(len(columns[0]))]


def window_logit(inputs, p):
    """inputs: the windows' word vectors; p: the trained parameters as lists."""
    h = len(p["state_f"])
    states = {}
    for side, steps in (("f", range(len(inputs))), ("b", reversed(range(len(inputs))))):
        now = [0.0] * h
        for t in steps:
            x = [a + b for a, b in zip(dot(inputs[t], p[f"in_{side}"]), p[f"gate_{side}"])]
            own = dot(now, p[f"state_{side}"])
            s = lambda v: 1 / (1 + math.exp(-v))
            z = [s(x[k] + own[k]) for k in range(h)]
            r = [s(x[h + k] + own[h + k]) for k in range(h)]
            n = [math.tanh(x[2 * h + k] + r[k] * own[2 * h + k]) for k in range(h)]
            now = [n[k] + z[k] * (now[k] - n[k]) for k in range(h)]
            states[side, t] = now
    rows = [states["f", t] + states["b", t] for t in range(len(inputs))]
    e = [sum(a * b for a, b in zip(row, p["attention"])) for row in rows]
    weights = [math.exp(v - max(e)) for v in e]
    total = sum(weights)
    pooled = [sum(w * row[k] for w, row in zip(weights, rows)) / total for k in range(2 * h)]
    return sum(a * b for a, b in zip(pooled, p["out"])) + p["bias"][0]

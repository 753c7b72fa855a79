from __future__ import annotations

import hashlib
import random
import re
import time

from samples import corpus, prose

from tonnage.llm.licences import PHRASES, TEMPLATES, SuffixAutomaton, scan_licences
from tonnage.llm.secret_scan import apart, literal_spans, scan_secrets


def test_matching_statistics_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        lists = [[rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(3)]
        text = [rng.randrange(4) for _ in range(20)]
        held = {tuple(x[i:j]) for x in lists for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
        longest = [max(k for k in range(e + 1) if k == 0 or tuple(text[e - k : e]) in held) for e in range(1, 21)]
        want = [(e, longest[e - 1]) for e in range(1, 21) if longest[e - 1] >= 2 and (e == 20 or longest[e] != longest[e - 1] + 1)]
        automaton = SuffixAutomaton(lists)
        assert [(e, n) for e, n, _ in automaton.matches(text, 2)] == want
        for e, n, state in automaton.matches(text, 2):
            places = [(k, j) for k, x in enumerate(lists) for j in range(n, len(x) + 1) if x[j - n : j] == text[e - n : e]]
            assert sorted(automaton.ends[state]) == places


def licence_base(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, labels = [], set()
    for phrase, label in PHRASES:
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


NOTICES = [
    "MIT\nLicense mit-license MIT LICENSES", "the GNU General Public License, the Apache license", "general public", "license mit",
    prose(1, 30) + " Permission is hereby granted, free of charge, to ANY person obtaining a copy of this software and associated docs files to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "Licensed under CC BY-NC 4.0.", "permission is hereby granted to leave", "mit é license", "mit", "license",
]


def test_licences(documents):
    rows = corpus() + [(200 + i, t, "a") for i, t in enumerate(NOTICES)] + [(300 + i, f"x {t} y", "a") for i, (_, t) in enumerate(TEMPLATES)]
    found = scan_licences(documents(rows)).collect()
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert sorted(str((r.doc_id, *(r[c] for c in columns))) for r in found) == sorted(str((i, *licence_base(t))) for i, t, _ in rows)
    by_id = {r.doc_id: r for r in found}
    assert by_id[204].labels == "mit" and 0.8 <= by_id[204].score < 1 and by_id[205].labels == "cc-by-nc"
    assert by_id[206].labels == "" and by_id[206].score < 0.8
    for i, (label, _) in enumerate(TEMPLATES):
        assert label in by_id[300 + i].labels.split(",") and by_id[300 + i].score == 1
    for r in found:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))
    assert scan_licences(documents([])).collect() == []


def secret_base(text):
    text, spans = text or "", []
    name = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    assign = rf"""({name}|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [[m.span() for m in re.finditer(assign, text) if len(m[2]) >= 6]]
    found += [[m.span() for m in re.finditer(p, text) if len(m[0]) >= n] for p, n in (("AKIA[A-Z0-9]+", 20), ("[0-9a-f]+", 24))]
    for kind, (name, many) in enumerate(zip(("assign", "access", "hex"), found, strict=True)):
        spans += [(a, kind, f"{name}:{a}:{b}") for a, b in many]
    return (*map(len, found), hashlib.sha256(",".join(s for *_, s in sorted(spans)).encode()).hexdigest())


SECRETS = [
    'é password = "hunter22"', "PassWD:token:abcdefgh", "token==abcdef", "api-key: abcdefgh apikey='12345' api_KEY=1234567", "ſecret=abcdefgh toKen=abcdefgh",
    "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 15, "AKIA" + "9" * 15, "f" * 24 + "g" + "0" * 23, "secret:" + "a" * 30, "中 " * 5 + "0123456789abcdef01234567",
    "secret=short secret=longer1", "password : ' x", "token=" + "=" * 6,
]


def test_a_match_that_jumps_ahead_blocks_no_other(documents):
    words = [f"w{i}" for i in range(40)]
    notice = (("own", " ".join(words)),)
    text = " ".join(words[:10] + words[36:] + words[10:36])
    row = scan_licences(documents([(1, text, "a"), (2, " ".join(words[10:36]), "a")]), notice, ()).orderBy("doc_id").collect()
    assert [r.labels for r in row] == ["own", ""]
    assert abs(row[0].score - 0.9) < 1e-9 and [(s.start, s.end) for s in row[0].spans] == [(0, 40)]


def test_secrets_against_brute_force(documents):
    rng = random.Random(3)
    parts = ["token", "secret", "AKIA", "=", ":", " ", "'", "a1", "Z", "f" * 11, "password", "-", "\n", "é"]
    rows = corpus() + [(400 + i, t, "a") for i, t in enumerate(SECRETS)]
    rows += [(600 + i, "".join(rng.choices(parts, k=30)), "a") for i in range(200)]
    found = scan_secrets(documents(rows)).collect()
    columns = ["n_assign", "n_access", "n_hex", "base_sha256"]
    assert sorted(str((r.doc_id, *(r[c] for c in columns))) for r in found) == sorted(str((i, *secret_base(t))) for i, t, _ in rows)
    for r in found:
        base = [s for s in r.spans.split(",") if s and not s.startswith("literal")]
        assert len(base) == r.n_assign + r.n_access + r.n_hex
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
    assert scan_secrets(documents([])).collect() == []


def literals(text):
    return [text[a:b] for a, b, _ in literal_spans(text)]


def test_literals_reach_names_over_others():
    assert literals('base = "hunter2XkQ9"\nlast = base\ndb_pwd = last\n') == ["hunter2XkQ9"]
    assert literals('private_key := "MIIEv9" + "QIBADANBg9"') == ["MIIEv9", "QIBADANBg9"]
    assert literals('{"dbPassphrase": "S3cr3t-Valu3"}') == ["S3cr3t-Valu3"]
    assert literals("client_key: 'A8f9-sdf7-QWER'") == ["A8f9-sdf7-QWER"]


def test_harmless_literals():
    for text in ('token_type = "Bearer12345"', "url: http://example.org/a1b2c3", 'pwd == "N0tassigned1"', "credential: your_credential_here", "name = 'S3cr3t-Valu3'"):
        assert literals(text) == []


def test_placeholders_are_whole_values():
    kept = ["xT9bQ2mVr7Lp0sKdW4", "p@ss$W0rd!9a", "Test8sdf7QWER", "myS3cr3tValu3", "your9Kd7Qw2Lp", ".h1dd3nQ8x", "100%Kd7Qw{2Lp", "a<b9Kd7>Qw2", "$2b$12$KIXQw9Zr", "${DB_PASS:-hunter2XkQ9}"]
    for value in kept:
        assert literals(f'db_passphrase = "{value}"') == [value]
    # Beside a reference, what the literal adds itself counts.
    assert literals('pwd = "Kd7Qw2Lp${SALT}9aZ"') == ["Kd7Qw2Lp${SALT}9aZ"]
    dropped = ["xxxxxxxx", "XXXX-XXXX-XXXX", "********", "........", "changeme", "CHANGE_ME", "your_access_key_here", "my-secret-token", "undefined", "example.password"]
    dropped += ["${DB_PASSWORD_2}", "$DB_PASSWORD_2", "$(cat /run/key1)", "%(db_pass1)s", "{{ vault.key1 }}", "${{ secrets.KEY1 }}", "<your key 1>", "{password1}", "%PASSWORD1%", "Bearer ${API_TOKEN1}", "Bearer $API_TOKEN1", "Bearer {token}"]
    for value in dropped:
        assert literals(f'db_passphrase = "{value}"') == []


def test_no_length_is_too_long():
    rng = random.Random(4)
    key = "".join(rng.choices("abcXYZ0189", k=9000))
    assert literals(f'access_key = "{key}"\npwd: {key}\n') == [key, key]
    assert literals(f'{"long_" * 40}passphrase = "S3cr3t-Valu3"') == ["S3cr3t-Valu3"]
    assert literals(f'pwd{" " * 40}={" " * 40}"S3cr3t-Valu3"{" " * 20}+{" " * 20}"An0ther1"') == ["S3cr3t-Valu3", "An0ther1"]
    parts = [f"pArt{i}" for i in range(100)]
    assert literals("passphrase = " + " + ".join(f'"{p}"' for p in parts)) == parts
    chain = 'k0 = "pArt0"\n' + "".join(f'k{i} = k{i - 1} + "pArt{i}"\n' for i in range(1, 100))
    assert literals(chain + "pwd = k99\npassphrase = k98 + k99") == parts and literals(chain + "pwd = k49") == parts[:50]
    # A nested setting, however deep, is no value of the name above it.
    assert literals("credentials:\n" + " " * 12 + "pwd: S3cr3t-Valu3\n") == ["S3cr3t-Valu3"]
    # Two names that share literals count each of them once.
    assert literals('a = "S3cr"\nb = a + "xxxxxx"\nc = a + "xxxxxx"\npwd = b + c') == literals('a = "S3cr"\npwd = a')


def test_time_follows_the_text():
    for text in ("token = token + 'pArt1'\n" * 20000, 'pwd = "' * 60000, "pwd" + " " * 400000 + "x", "a\n" * 200000, 'p="\\"' * 80000, "pwd:\n" * 80000, "pwd = my" + "secretkey" * 40000):
        begin = time.perf_counter()
        literal_spans(text)
        assert time.perf_counter() - begin < 20


def test_spans_apart_from_base_spans():
    rng = random.Random(9)
    for _ in range(300):
        base = sorted((a, rng.randrange(3), a + rng.randrange(1, 9)) for a in (rng.randrange(60) for _ in range(rng.randrange(7))))
        spans = [(a, a + rng.randrange(1, 9), 0.5) for a in (rng.randrange(60) for _ in range(9))]
        assert apart(spans, base) == [x for x in spans if not any(a < x[1] and x[0] < b for a, _, b in base)]


def test_many_base_spans_and_literals_in_one_text(documents):
    text = "".join(f'token = "aB{i:06}zz"\npwd = "xY{i:06}kk"\n' for i in range(30_000))
    start = time.time()
    row = scan_secrets(documents([(1, text, "a")])).collect()[0]
    assert time.time() - start < 60
    assert row.n_assign == 30_000 and row.spans.count("literal") == 30_000


def test_phrases_by_their_names():
    def found(text):
        return [text[a:b] for a, b, _ in literal_spans(text)]

    assert found('passphrase = "correct horse battery staple9"') == ["correct horse battery staple9"]
    assert found('seed_phrase_secret: "Ivory 7 lamp Orbit zebra 3"') == ["Ivory 7 lamp Orbit zebra 3"]
    assert found('pwd_note = "ask the Admin for the 2 words"') == []

"""The labelled table that the personal-data field learns from: sentences with their
personal data marked as ``{kind|text}``, and sentences that have none though they hold
numbers, dots and the word at. All names, hosts and numbers are made up."""

from __future__ import annotations

import re


SENTENCES = (
    # written-out and bracketed addresses
    "Write to {email|mara dot lindt at example dot org} for the minutes.",
    "You can reach me under {email|jon.bell at mail dot example dot com} any day.",
    "Contact: {email|press at firma dot example}",
    "His address is {email|o.keller (at) example (dot) net} as far as I know.",
    "mail {email|sales [at] shop [dot] example [dot] com} or call",
    "Send it to {email|lena(at)example.org} please.",
    "ask {email|team[at]example[dot]com} about it",
    "Please use {email|r dot moreau at example dot fr} instead.",
    "the list owner {email|admin {at} lists {dot} example {dot} org} replied",
    "Her new mail, {email|ida.voss(at)mail.example.net}, works.",
    "write {email|kim at example dot io} before noon",
    "Bitte an {email|vertrieb (at) firma (dot) example} senden.",
    "Schreib an {email|paul dot weber at example dot de} und warte.",
    "Envoyez à {email|claire [at] exemple [dot] fr} votre avis.",
    "escribe a {email|luis dot vega at ejemplo dot es} hoy",
    "reply to {email|no.reply at updates dot example dot com} is not read",
    "{email|info at example dot org} answers within a day",
    "From {email|t.ross at cs dot uni dot example} with thanks",
    "The editor ({email|desk [at] paper [dot] example}) agreed.",
    "his handle {email|nadia dot k at example dot co} changed",
    "the notes of {email|rob(at)mail.example} were lost",
    "we heard from {email|eva[at]host[dot]example} today",
    "so {email|m.stone(at)office.example.com} and others know",
    "her friend {email|will[at]post[dot]example[dot]org} moved",
    "I think {email|ben at home dot example} is the one",
    "they know {email|amy dot fox at work dot example} well",
    "then {email|sam at club dot example dot net} wrote back",
    "a note by {email|j.poe (at) site (dot) example} was found",
    # telephone numbers without a plus
    "he wrote {phone|0043 1 5550177} on the wall",
    "they gave {phone|0049 89 5550166} as theirs",
    "Call {phone|(212) 555-0147} after six.",
    "Call {phone|(415) 555-0199} or come by.",
    "Tel. {phone|(030) 555-0123} bis Freitag",
    "phone {phone|212-555-0188} today",
    "My number is {phone|646-555-0102} now.",
    "phone: {phone|718.555.0164} evenings",
    "call {phone|303.555.0137} for prices",
    "reach us at {phone|(617) 555-0110} daily",
    "Fax {phone|(808) 555-0155} if you must",
    "ring {phone|0049 30 5550123} for the desk",
    "Phone {phone|0033 1 55501234} in Paris",
    "mobile {phone|503-555-0171} , ask for Ann",
    "Telefon {phone|0041 44 5550199} am Abend",
    "tel {phone|(702) 555-0133} weekdays",
    "dial {phone|1-800-555-0142} free of charge",
    "hotline {phone|1-888-555-0108} day and night",
    # cards in other groupings
    "paid by card {card|4111.1111.1111.1111} yesterday",
    "card number {card|5500.0000.0000.0004} declined",
    "Visa {card|4012.8888.8888.1881} on file",
    "card {card|4111_1111_1111_1111} expired",
    "Karte {card|4222/2222/2222/2220} gesperrt",
    "charged {card|3400.000000.00009} twice",
    "card no {card|6011.0009.9013.9424} ok",
    "Mastercard {card|5105_1051_0510_5100} used",
    # addresses of machines in other spellings
    "host {ip|10[.]0[.]0[.]7} blocked",
    "from {ip|192[.]168[.]4[.]20} again",
    "traffic to {ip|203[.]0[.]113[.]9} stopped",
    "server {ip|198(.)51(.)100(.)23} is down",
    "scan of {ip|172[.]16[.]33[.]2} done",
    "logged in from {ip|203(.)0(.)113(.)77} at night",
    # well-formed ones, as the patterns find them
    "Write to {email|ann.lee@example.com} soon.",
    "mail {email|x-7@mail.example.org} or",
    "call {phone|+1 (212) 555-0100} now",
    "host {ip|203.0.113.5} answered",
    "card {card|4111 1111 1111 1111} valid",
    # none at all
    "We met at 7 and left at 9.",
    "It was at least 12 dot points long.",
    "Look at section 4.2.1 of the book.",
    "version 3.11.4 came out in 2023",
    "The dot on the map is at the river.",
    "connect the dot to the line at the top",
    "a dot com firm from the nineties",
    "a polka dot dress at the fair",
    "She was at home, dot the i and cross the t.",
    "order 2024-0017-3345 was shipped on 2024-03-05",
    "Invoice 555-0147 is due in 30 days",
    "ISBN 978-3-16-148410-0 is out of print",
    "the years 1999-2004 were dry",
    "price 1.299.000 or 12.50 each",
    "pages 212-214 and 303-305",
    "part no. 4111.22 fits",
    "at 10.30 on 12.04.2021 in room 3",
    "score 3-2 at half time",
    "a total of 1,234,567.89 at the end",
    "serial 00A1-77B2-99C3 was sold",
    "meet me [at] the gate 4",
    "see (at 5) and (dot 3) in the plan",
    "section (4) (at) the end of 2020",
    "7 of 10 (dot) plots were kept",
    "tel aviv 2019 was hot",
    "call 3 of 5 failed",
    "card 7 of 52 is red",
    "phone 12 of the batch broke",
    "host 5 has 16 cores",
    "mail 300 letters by 5 pm",
    "account 9777946427004852 at the bank",
    "reference 4736962573099581 of 2020",
    "id 8812345678901234 and 77",
    "temperature of 36.6.20 is a typo",
    "the ratio 10(.)2 was odd",
    "chapter 1[.]2 was cut",
)


#: Every marked piece is a row once more in each of these, so that it is known by its
#: shape and not by the word before it.
FRAMES = ("then {} came", "of {}, and so on", "it was {} all along.")


def labelled() -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(text, spans) of every row; a span is (kind, start, end)."""
    whole = _parsed(SENTENCES)
    pieces = [f"{{{kind}|{text[s:e]}}}" for text, spans in whole for kind, s, e in spans]
    return whole + _parsed(frame.replace("{}", piece) for piece in pieces for frame in FRAMES)


def _parsed(sentences) -> list[tuple[str, list[tuple[str, int, int]]]]:
    out = []
    for sentence in sentences:
        text, spans, at = "", [], 0
        for m in re.finditer(r"\{(email|ip|card|phone)\|", sentence):
            if m.start() < at:
                continue
            end = _closing(sentence, m.end())
            text += sentence[at:m.start()]
            body = sentence[m.end():end]
            spans.append((m.group(1), len(text), len(text) + len(body)))
            text += body
            at = end + 1
        out.append((text + sentence[at:], spans))
    return out


def _closing(s: str, at: int) -> int:
    """The brace that closes a mark whose text begins at ``at``; the text may have braces."""
    depth = 1
    while True:
        depth += (s[at] == "{") - (s[at] == "}")
        if not depth:
            return at
        at += 1

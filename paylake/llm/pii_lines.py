"""A small labelled table: lines with the personal data that base patterns miss, and decoys.

A span stands as ``[kind text]]``.  Fixed values, labelled by hand.
"""

LINES = (
    # addresses whose signs are written out
    "write to [email john.smith (at) example (dot) com]] for the papers",
    "you can reach me at [email maria at example dot org]]",
    "contact: [email info [at] shop [dot] net]]",
    "mail [email anna.k(at)web(dot)com]] or come by",
    "send it to [email p.meier @ firma.de]], please",
    "[email support [at] host.net]] answers within a day",
    "my address is [email lee (at) mail.example.com]] since May",
    "[email bob {at} site {dot} org]] and nobody else",
    "Kontakt: [email k.wolf (at) verein (dot) org]]",
    "ask [email sales at shop dot com]] about the price",
    # ips with blanks or brackets
    "the host [ip 10 . 0 . 12 . 7]] does not answer",
    "blocked [ip 192 [.] 168 [.] 4 [.] 20]] again",
    "ping [ip 172.16 .4.9]] first",
    "traffic from [ip 198[.]51[.]100[.]7]] and others",
    "sample calls [ip 45[.]33[.]2[.]190]] each hour",
    "seen from [ip 203(.)0(.)113(.)8]] at night",
    "gateway [ip 10.1. 2. 3]] is down",
    "log: [ip 198 .51 .100 .23]] refused",
    # cards with other separators
    "card [card 4111.1111.1111.1111]] was charged",
    "paid by [card 5500/0000/0000/0004]] yesterday",
    "number [card 4012  8888  8888  1881]] please keep it",
    "visa: [card 4111_1111_1111_1111]] valid to 12/29",
    "the card [card 3782.822463.10005]] is lost",
    "use [card 6011 - 1111 - 1111 - 1117]] for the trip",
    # phones without a country code
    "call [phone (030) 123 4567]] before noon",
    "call me: [phone 030-1234567]]",
    "tel. [phone 0171 234 56 78]]",
    "phone [phone 555-0134-221]] or write",
    "ring [phone 01 23 45 67 89]] tomorrow",
    "office [phone (212) 555-0187]], ask for Ann",
    "fax [phone 089/1234567]]",
    "my number is [phone 020 7946 0958]]",
    "mobile [phone 07700 900123]] after six",
    "reach us under [phone 0800.123.4567]]",
    "dial [phone 0049 30 901820]] from abroad",
    "Tel: [phone 06131-123456]] (home)",
    "SMS to [phone (0151) 2345 6789]] works too",
    "numero [phone 06 12 34 56 78]] le soir",
    # two at once
    "call [phone 030-1234567]] or mail [email tom (at) example (dot) com]]",
    "from [ip 10 . 2 . 3 . 4]] by [email root at host dot net]]",
    # decoys
    "order 1234567 shipped on 2024-01-05",
    "invoice 2531585014589253 is open",
    "see you at home dot the door is open",
    "he was at work at 10 and at 12",
    "version 1.2.3 of 2023 and 4.5.6 of 2024",
    "the sum of 12 . 5 and 300 . 7 is wrong",
    "on 05.06.2021 at 10:30 in room 204",
    "ISBN 978-3-16-148410-0 costs 24.90",
    "population 8336817 in 2022",
    "section 3.1.4.159 of the rules",
    "between 1914 and 1918 or 1939 and 1945",
    "part no. 4711-0815-2000 in stock",
    "id 00012345678 of table 7",
    "it ran from 100 to 250 in 12 steps",
    "1,234,567 people and 89,012 cars",
    "score 21:19 21:17 after 45 minutes",
    "chapter 7 (page 123) and 8 (page 456)",
    "coordinates 52.5200 13.4050 north",
    "the ratio is 3/4 and not 5/8",
    "serial 88005553535123456789 is too long",
    "look at (this) and (that) dot",
    "at 5 a.m. (at least) he came",
    "PIN 4821, room 17, floor 3",
    "account 12345678901234567 was closed",
)

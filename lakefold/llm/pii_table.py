"""The small labelled table that the personal-data tagger learns from.

Own sentences; ``{kind|text}`` marks a span.  Fixed values, in plain text.
"""

TABLE = [
    "write to {email|maria dot lopez at mail dot example dot com} for details",
    "mail me : {email|tom [at] post [dot] example [dot] net} any time",
    "her address is {email|anna (at) server (dot) example (dot) org} I think",
    "reach us under {email|info at shop dot example dot de} or come by",
    "send it to {email|k.berg (at) uni.example.edu} by Friday",
    "questions go to {email|lee [at] lab.example.org} please",
    "contact {email|support at site dot example dot com} today",
    "Kontakt : {email|jan punkt meier at post punkt example punkt de} danke",
    "escribe a {email|luis (arroba) correo.example.es} hoy",
    "mail {email|paul.f at mail dot example dot fr} merci",
    "call {phone|(212) 555-0187} after six",
    "phone : {phone|415-555-0132} ask for Dana",
    "tel {phone|030 5550 1774} between nine and five",
    "ring me on {phone|555 013 2298} tonight",
    "her mobile is {phone|0171 555 0192} now",
    "Tel. {phone|(089) 555 0147} werktags",
    "telefono {phone|91 555 01 23} por la tarde",
    "fax {phone|(0)30-555-0166} only",
    "my number is {phone|917.555.0148} call me",
    "phone {phone|0044 20 5550 0112} in London",
    "call {phone|(684) 555-7766} or write",
    "you can phone {phone|(058) 555-3468} and ask",
    "credit card {card|4000 0000 0000 0000} expired",
    "card number {card|5100-0000-0000-0000} was declined",
    "pay with visa {card|4111000000000000} please",
    "Karte {card|3700 000000 00000} gesperrt",
    "charged card {card|6011 0000 0000 0009} twice",
    "the server at {ip|10 . 20 . 30 . 40} is down",
    "ping {ip|192 [.] 168 [.] 4 [.] 17} first",
    "host {ip|172[.]16[.]5[.]9} answers",
    "ip address {ip|10[.]0[.]0[.]77} logged",
    "the cat sat on the mat at noon",
    "we met at the dot of nine in the hall",
    "he looked at her and said nothing at all",
    "In 1998 about 300 people lived there , in 2004 only 120 .",
    "The price rose from 20 to 35 ( up 15 ) in three days .",
    "See chapter 4 . 2 of the report ( page 117 - 119 ) .",
    "version 3 . 11 . 2 was released on 2021 - 05 - 17",
    "order 4000123 shipped on 12 / 06 / 2019 , box 7",
    "It was at 10 : 30 . Then , at 11 : 45 , we left .",
    "the sum of 1 2 3 4 5 and 6 is 21",
    "token = \" 9c8b45435718dcc700c184a7e303 \" was found",
    "id 0123456789 in table 7 has 25 rows",
    "serial 9876543210987654 of the machine",
    "row 5295745161764470 and column 12",
    "number 0445617099674829 came up",
    "Released under the MIT License .",
    "Licensed under the Apache License , Version 2.0 .",
    "GNU General Public License , version 3 .",
    "He scored 21 - 15 , 19 - 21 and 21 - 18 .",
    "WOW !! BUY !! NOW !! 50 % OFF !! ONLY !! TODAY !!",
    "the*** quick### brown$$$ fox%%% jumps&&& over***",
    "| name | value | 12 | 7 | total | 19 |",
    "der Mann ging nach Hause und schlief um 22 Uhr",
    "la casa de la calle 25 es muy grande",
    "la maison est au numero 14 de la rue",
    "at last , the dot on the map was 40 miles away",
    "look at mail from the lab at the end of the day",
    "please call at the card shop ; phone first",
    "visa and card and tel and phone and mobile",
    "She looked at hand and ring , then at noon in the inn .",
    "To be at ease is to be in the end at home . It is at all times .",
    "this is that at other and at reading of it",
    "a b c d e f g h i j k",
    "ISBN 0 306 40615 2 is a book",
    "temperatures of 12.5 and 13.75 in May",
    "1 . 5 million and 2 . 25 million in 2010",
    "zip 10115 , Berlin ; zip 28013 , Madrid",
]

"""Small inputs.

Fixed values: the figures the tests expect were derived by hand from exactly
these inputs.
"""

QUALITY_ROWS = [("1", "a@x.com", "34"), ("2", "bad-email", "212"), ("2", "c@x.com", "")]
# One mailbox and a host with a dot, no further at sign.
EMAIL_PATTERN = r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"

SOURCE_ROWS = [
    ("C1", "M10", "250.00", "PAID"),
    ("C2", "M11", "80.00", "PAID"),
    ("C3", "M12", "310.50", "DENIED"),
    ("C3", "M12", "310.50", "DENIED"),
]
TARGET_ROWS = [
    ("C1", "M10", "250.00", "PAID"),
    ("C2", "M11", "80.00", "PENDING"),
    ("C4", "M13", "45.00", "PAID"),
]

# Log lines, one of them unreadable.
LOG_LINES = [
    '1.1.1.1 - - [10/Jul/2026:13:55:36] "GET /api/users HTTP/1.1" 200 342 18',
    '1.1.1.1 - - [10/Jul/2026:13:55:37] "GET /api/orders HTTP/1.1" 200 1204 640',
    '2.2.2.2 - - [10/Jul/2026:13:55:38] "POST /api/login HTTP/1.1" 401 - 25',
    '3.3.3.3 - - [10/Jul/2026:13:55:39] "GET /api/orders HTTP/1.1" 500 0 880',
    '1.1.1.1 - - [10/Jul/2026:13:55:40] "GET /health HTTP/1.1" 200 2 3',
    'not a log line',
    '2.2.2.2 - - [10/Jul/2026:13:55:41] "GET /api/users HTTP/1.1" 404 - 12',
]

PATIENTS = [(1, "Asha Rao", "GA"), (2, "Ben Ortiz", "TX"), (3, "Chen Wei", "GA"), (4, "Dana Smith", "NY")]
CLAIMS = [
    (101, 1, "Lab Panel", 250.00, "2026-07-01"),
    (102, 1, "X-Ray", 410.50, "2026-07-03"),
    (103, 2, "Office Visit", 125.00, "2026-07-03"),
    (104, 3, "MRI", 1899.99, "2026-07-05"),
    (105, 99, "Office Visit", 130.00, "2026-07-06"),
    (106, 2, "Office Visit", 125.00, "2026-07-03"),
    (107, 3, "Lab Panel", -40.00, "2026-07-08"),
]

MESSY_HEADER = "member_id,name,age,monthly_premium"
MESSY_RECORDS = [
    "101, Asha Rao ,34,220.50",
    "102,Ben Ortiz,,180",
    " ,Cara Lin,29,205.75",
    "104,Dev Patel,41,",
    "105,Elena Cruz,52,240.00",
]

FORECAST_LINES = [
    "Phoenix 116/95/s 118/92/s",
    "Las Vegas 111/91/t 114/92/s",
    "Salt Lake City 100/78/t 103/78/pc",
    "Albuquerque 98/74/t 93/72/t",
    "Dallas 97/80/s 101/81/pc",
    "Denver 95/71/t 98/69/pc",
    "Minneapolis 80/69/s 95/74/s",
    "Miami 91/80/t 94/79/sh",
    "New Orleans 94/77/t 94/79/sh",
    "Chicago 81/66/s 82/71/pc",
    "Boston 79/64/s 77/61/s",
    "New York City 82/66/s 82/67/s",
    "Seattle 87/62/s 74/60/pc",
    "San Francisco 79/60/pc 73/61/pc",
    "Anchorage 67/51/pc 68/53/s",
    "Honolulu 88/75/sh 88/75/sh",
    "Nashville 86/70/pc 83/74/t",
    "Bad Row 999/xx/z 12/9/q",
]

CITIES = ["Hyderabad", "", "Chennai", "?", "Hyderabad", "NA", "Chennai", "Hyderabad", None]

# Entity, language and name.
NAMES = [
    ('Tesla', 'English', 'Tesla'),
    ('Tesla', 'Chinese', '特斯拉'),
    ('Tesla', 'Japanese', 'テスラ'),
    ('Tesla', 'Hindi', 'टेस्ला'),
    ('Tesla', 'Telugu', 'టెస్లా'),
    ('Tesla', 'Russian', 'Тесла'),
    ('SpaceX', 'English', 'SpaceX'),
    ('SpaceX', 'Chinese', '太空探索技术公司'),
    ('SpaceX', 'Japanese', 'スペースX'),
    ('SpaceX', 'Hindi', 'स्पेसएक्स'),
    ('SpaceX', 'Telugu', 'స్పేస్\u200cఎక్స్'),
    ('SpaceX', 'Russian', 'СпейсИкс'),
    ('Neuralink', 'English', 'Neuralink'),
    ('Neuralink', 'Chinese', '神经链接'),
    ('Neuralink', 'Japanese', 'ニューラリンク'),
    ('Neuralink', 'Hindi', 'न्यूरालिंक'),
    ('Neuralink', 'Telugu', 'న్యూరాలింక్'),
    ('Neuralink', 'Russian', 'Нейралинк'),
    ('xAI', 'English', 'xAI'),
    ('xAI', 'Chinese', 'xAI'),
    ('xAI', 'Japanese', 'xAI'),
    ('xAI', 'Hindi', 'xAI'),
    ('xAI', 'Telugu', 'xAI'),
    ('xAI', 'Russian', 'xAI'),
]

# 94 words in two paragraphs; sentences end after these words.
SENTENCE_ENDS = (9, 16, 29, 43, 53, 64, 78, 93)
FIRST_PARAGRAPH_END = 43


def prose():
    out = []
    for i in range(94):
        out.append(f"w{i}." if i in SENTENCE_ENDS else f"w{i}")
        out.append("\n\n" if i == FIRST_PARAGRAPH_END else " ")
    return "".join(out)

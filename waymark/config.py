"""Default vocabularies and rules.

Everything here is a fixed value: word lists, lookup tables and thresholds that
decide results and therefore have to be spelled out. All operators take them as
arguments; nothing below is read by an operator on its own.
"""

from __future__ import annotations

# Regions in matching order; box = (min_lon, min_lat, max_lon, max_lat).
REGIONS = [
    {"id": "bandar_lampung", "name": "Kota Bandar Lampung", "query": "Bandar Lampung", "box": (105.15, -5.48, 105.35, -5.33)},
    {"id": "metro", "name": "Kota Metro", "query": "Metro", "box": (105.25, -5.18, 105.38, -5.08)},
    {"id": "lampung_selatan", "name": "Kabupaten Lampung Selatan", "query": "Lampung Selatan", "box": (105.00, -6.00, 105.90, -5.15)},
    {"id": "lampung_tengah", "name": "Kabupaten Lampung Tengah", "query": "Lampung Tengah", "box": (104.58, -5.25, 105.65, -4.55)},
    {"id": "lampung_timur", "name": "Kabupaten Lampung Timur", "query": "Lampung Timur", "box": (105.25, -5.35, 105.95, -4.60)},
    {"id": "lampung_utara", "name": "Kabupaten Lampung Utara", "query": "Lampung Utara", "box": (104.55, -5.05, 105.15, -4.50)},
    {"id": "lampung_barat", "name": "Kabupaten Lampung Barat", "query": "Lampung Barat", "box": (103.55, -5.45, 104.50, -4.70)},
    {"id": "pesawaran", "name": "Kabupaten Pesawaran", "query": "Pesawaran", "box": (104.90, -5.85, 105.30, -5.15)},
    {"id": "tanggamus", "name": "Kabupaten Tanggamus", "query": "Tanggamus", "box": (104.30, -5.75, 104.95, -5.10)},
    {"id": "pringsewu", "name": "Kabupaten Pringsewu", "query": "Pringsewu", "box": (104.85, -5.50, 105.10, -5.15)},
    {"id": "pesisir_barat", "name": "Kabupaten Pesisir Barat", "query": "Pesisir Barat", "box": (103.50, -5.95, 104.15, -4.80)},
    {"id": "tulang_bawang", "name": "Kabupaten Tulang Bawang", "query": "Tulang Bawang", "box": (105.10, -4.75, 105.90, -4.10)},
    {"id": "tulang_bawang_barat", "name": "Kabupaten Tulang Bawang Barat", "query": "Tulang Bawang Barat", "box": (104.75, -4.70, 105.25, -4.20)},
    {"id": "mesuji", "name": "Kabupaten Mesuji", "query": "Mesuji", "box": (105.20, -4.30, 105.85, -3.80)},
    {"id": "way_kanan", "name": "Kabupaten Way Kanan", "query": "Way Kanan", "box": (104.15, -4.85, 105.05, -4.20)},
]
DEFAULT_REGION = "Kota Bandar Lampung"
# Fixed value: target area (min_lon, min_lat, max_lon, max_lat).
TARGET_BOX = (103.0, -6.5, 106.5, -3.5)

# Slug order decides substring matches.
REGION_SLUGS = {
    "bandar_lampung": "Kota Bandar Lampung",
    "lampung_barat": "Kabupaten Lampung Barat",
    "lampung_selatan": "Kabupaten Lampung Selatan",
    "lampung_tengah": "Kabupaten Lampung Tengah",
    "lampung_timur": "Kabupaten Lampung Timur",
    "lampung_utara": "Kabupaten Lampung Utara",
    "mesuji": "Kabupaten Mesuji",
    "pesawaran": "Kabupaten Pesawaran",
    "pesisir_barat": "Kabupaten Pesisir Barat",
    "pringsewu": "Kabupaten Pringsewu",
    "tanggamus": "Kabupaten Tanggamus",
    "tulang_bawang": "Kabupaten Tulang Bawang",
    "tulang_bawang_barat": "Kabupaten Tulang Bawang Barat",
    "way_kanan": "Kabupaten Way Kanan",
    "metro": "Kota Metro",
}

# Words dropped from a name before matching.
NAME_STOP_PHRASES = [
    "tempat", "wisata", "destinasi", "objek", "pantai", "beach", "curup", "air terjun",
    "waterfall", "gunung", "mount", "bukit", "hill", "pulau", "island", "danau", "lake",
    "taman", "park", "hutan", "forest", "desa", "kampung", "situs", "museum", "cagar",
    "waterpark", "kebun", "zoo", "gua", "cave", "bendungan", "waduk", "pemandian",
    "sumber air panas", "camping ground", "spot", "sunrise", "sunset", "kabupaten",
    "kota", "kecamatan", "kelurahan", "lampung",
]

# Fixed values: (words found in categories or name, tags they give).
TAG_RULES = [
    (["pantai", "beach"], ["beach", "nature"]),
    (["pulau", "island"], ["island", "nature"]),
    (["gunung", "mount"], ["mountain", "nature"]),
    (["bukit", "hill"], ["hill", "nature"]),
    (["air terjun", "waterfall", "curup"], ["waterfall", "nature"]),
    (["danau", "lake"], ["lake", "nature"]),
    (["sungai", "river"], ["river", "nature"]),
    (["hutan", "forest", "mangrove"], ["forest", "nature"]),
    (["camping", "kemah"], ["camping", "nature"]),
    (["museum"], ["museum", "culture"]),
    (["sejarah", "historic", "candi", "situs", "monumen"], ["history", "culture"]),
    (["religi", "masjid", "church", "temple", "makam"], ["religious", "culture"]),
    (["edukasi", "education"], ["education"]),
    (["taman", "park"], ["park"]),
    (["waterpark", "water park", "kolam"], ["waterpark", "recreation"]),
    (["agro", "kebun", "sawah"], ["agrotourism", "nature"]),
    (["keluarga", "family", "hiburan", "bermain"], ["family", "recreation"]),
    (["rekreasi", "recreation", "zoo", "binatang"], ["recreation"]),
    (["alam", "nature"], ["nature"]),
    (["budaya", "culture", "adat", "seni"], ["culture"]),
]
TAG_PRIORITY = [
    "waterfall", "beach", "island", "mountain", "hill", "lake", "river", "forest",
    "camping", "museum", "history", "religious", "waterpark", "agrotourism",
    "education", "family", "recreation", "park", "culture", "nature", "other",
]

# Record classification vocabularies.
CLASSIFY = {
    "park_categories": ["taman", "park"],
    "park_name_words": [
        "wisata", "rekreasi", "hiburan", "mini", "bermain", "water", "safari",
        "keluarga", "flora", "fauna", "satwa", "hewan", "kupu-kupu", "bunga",
        "theme park", "amusement", "leisure", "agrowisata", "edukasi", "sakura",
        "outbound", "culinary", "kuliner", "selfie", "foto", "kelinci", "rusa", "hutan",
    ],
    "park_secondary": ["tujuan wisata", "taman hiburan", "pusat rekreasi", "cagar alam", "kebun binatang", "agrowisata"],
    "park_min_reviews": 15,
    "park_search": ["taman wisata", "wisata keluarga", "taman bermain", "taman kota"],
    "local_park_words": [
        "perumahan", "perum", "rt ", "rw ", "dharma wanita", "griya", "residence", "cluster",
        "komplek", "asrama", "kantor", "pkk", "kelurahan", "kecamatan",
    ],
    "lodging_categories": ["rumah wisata"],
    "lodging_pass_words": ["wisata", "pantai", "situs", "candi", "budaya"],
    "accepted": [
        "Tujuan Wisata", "Pantai", "Air Terjun", "Museum", "Taman Rekreasi Air",
        "Taman Hiburan", "Pusat Rekreasi", "Bumi Perkemahan", "Area Mendaki", "Tempat Bersejarah",
        "Cagar Alam", "Kebun Binatang", "Agrowisata", "Desa Wisata", "Tourist Attraction",
        "National Park", "Nature Preserve",
    ],
    "accepted_name_block": ["hotel", "homestay", "villa", "bengkel", "spbu", "paud", "sekolah"],
    "rejected": [
        "Hotel", "Penginapan", "Restoran", "Kafe", "Biro Perjalanan", "Agen Perjalanan",
        "Rental Mobil", "Agen Sewa Mobil", "Kantor Perusahaan", "Sekolah", "Taman Kanak-kanak",
        "Toko", "Pusat Perbelanjaan", "Dealer", "Bengkel", "SPBU", "Perumahan", "Lodge",
        "Coffee Shop", "Guest House", "Homestay", "Villa", "Rumah wisata",
    ],
    "manual": [
        "Tempat Ibadah", "Taman Lingkungan", "Lapangan", "Monumen Kecil", "Spot Foto Informal",
        "Masjid", "Gereja", "Pura", "Vihara", "Klenteng", "Mosque", "Church", "Temple",
    ],
    "rejected_name_words": [
        "hotel", "homestay", "guest house", "guesthouse", "villa", "penginapan", "resort", "warung", "cafe",
        "coffee", "kopi", "bengkel", "sekolah", "sdn", "smp", "sma", "paud", "tk", "toko", "cell", "mart",
        "spbu", "pertamina", "salon", "laundry", "apotek", "klinik", "kost", "kos-kosan",
    ],
    "accepted_name_words": [
        "wisata", "pantai", "curup", "air terjun", "pulau", "bukit", "gunung", "candi", "situs", "taman", "waterpark",
    ],
}

# Price research priority tiers, in order.
PRIORITY_TIERS = [
    ("high", ["waterpark", "museum", "recreation", "camping", "island", "tour", "activity", "rental", "guided",
              "family", "taman bermain", "playground", "theme park"]),
    ("medium", ["beach", "pantai", "taman", "park", "wisata", "zoo", "kebun binatang", "pool", "kolam"]),
    ("low", ["mosque", "mushola", "gereja", "monument", "landmark", "danau", "lake", "viewpoint", "bukit", "hill",
             "air terjun", "waterfall", "mountain", "gunung", "forest", "hutan"]),
]

# Category groups.
CATEGORY_GROUPS = {
    "nature": ["beach", "waterfall", "island", "forest", "hill", "mountain", "nature", "lake", "river"],
    "cultural": ["museum", "history", "culture", "religious", "education"],
    "recreation": ["park", "recreation", "camping", "waterpark", "family"],
}

# Entity resolution.
SOURCE_RANK = {"google_places": 0, "apify_google_maps": 0, "osm": 1, "official_sites": 2}
TRUSTED_SOURCES = ["google_places", "apify_google_maps"]
SHARED_DOMAINS = ["instagram.com", "facebook.com", "maps.google.com", "google.com", ""]
NO_PARENT_WORDS = [
    "biro", "travel", "tour", "agent", "trip", "sewa", "rent",
    "pelabuhan", "bakauheni",
    "desa", "kecamatan", "kabupaten", "provinsi", "pekon", "kelurahan",
    "kota", "posko", "sekretariat", "pam terbengkalai", "terbengkalai",
]
FACILITY_WORDS = [
    "parkiran", "parkir", "parking",
    "gapura", "gerbang", "pintu masuk", "entrance",
    "transportasi", "sewa motor", "sewa mobil", "rental", "ojek", "travel", "biro", "tour operator", "tour",
    "kantor", "office", "posko", "sekretariat", "pam terbengkalai", "terbengkalai",
    "dermaga", "pelabuhan",
]

# Feature vocabularies.
CATEGORY_VOCAB = [
    "agrotourism", "beach", "camping", "culture", "education", "family", "forest",
    "hill", "history", "island", "lake", "mountain", "museum", "nature",
    "other", "park", "recreation", "religious", "river", "waterfall", "waterpark",
]
REGION_VOCAB = [
    "Kabupaten Lampung Barat", "Kabupaten Lampung Selatan", "Kabupaten Lampung Tengah",
    "Kabupaten Lampung Timur", "Kabupaten Lampung Utara", "Kabupaten Mesuji",
    "Kabupaten Pesawaran", "Kabupaten Pesisir Barat", "Kabupaten Pringsewu",
    "Kabupaten Tanggamus", "Kabupaten Tulang Bawang", "Kabupaten Tulang Bawang Barat",
    "Kabupaten Way Kanan", "Kota Bandar Lampung", "Kota Metro",
]
FACILITY_VOCAB = [
    "has_parking", "has_toilet", "has_food", "has_prayer_room", "has_wheelchair_access",
    "has_guide", "has_lodging", "has_camping", "has_wifi", "has_transport",
]
FACILITY_LABEL_WORDS = {
    "has_guide": ["guide", "pemandu"],
    "has_lodging": ["penginapan", "homestay", "hotel", "villa"],
    "has_camping": ["camping", "kemah"],
    "has_wifi": ["wifi", "internet"],
    "has_transport": ["parkir", "transport", "angkot"],
}
SUMMARY_FACILITY_WORDS = {
    "has_parking": ["parkir", "parking"],
    "has_toilet": ["toilet", "restroom"],
    "has_food": ["makanan", "minuman", "food", "drink", "warung", "cafe", "restaurant", "restoran"],
    "has_prayer_room": ["mushola", "musholla", "masjid", "prayer", "ibadah"],
    "has_wheelchair_access": ["kursi roda", "wheelchair"],
}

# Sentiment lexicon (a two-word entry never equals a single token).
POSITIVE_WORDS = [
    "bagus", "indah", "cantik", "bersih", "keren", "mantap", "ramah", "nyaman",
    "seru", "luas", "murah", "rekomendasi", "suka", "puas", "asri", "sejuk",
    "estetik", "unik", "lengkap", "terjangkau", "terawat", "wajib", "sangat",
]
NEGATIVE_WORDS = [
    "kotor", "buruk", "jelek", "mahal", "kecewa", "bau", "rusak", "sempit",
    "panas", "kumuh", "macet", "kurang", "sayang", "kasihan", "mahalan", "bocor",
    "gelap", "sepi", "banyak sampah", "berantakan", "abaikan", "kasar",
]

# Price evidence rules.
EVIDENCE = {
    "commercial_categories": ["waterpark", "camping", "zoo", "aquarium", "amusement"],
    "commercial_terms": ["waterpark", "waterboom", "aquarium", "theme_park", "amusement", "camping",
                         "camping ground", "zoo", "kebun binatang"],
    "paid_facility_words": ["tiket", "bayar", "htm", "sewa", "tarif", "karcis", "biaya"],
    "cash_word": "tunai",
    "cash_pass_words": ["parkir", "tiket", "sewa", "masuk", "tarif"],
    "card_words": ["nfc", "kartu"],
    "map_sites": ["google.com/maps", "openstreetmap.org", "google.co.id/maps", "google.com"],
    "managed_name_words": ["resort", "waterpark", "waterboom", "taman wisata", "camp", "camping", "valley", "lembah",
                           "puncak", "amusement", "zoo", "kebun binatang", "agrowisata", "agrotourism", "outbound",
                           "swimming pool", "kolam renang"],
    "managed_description_words": ["dikelola", "pengelola", "tiket", "biaya", "tarif", "masuk", "buka", "tutup",
                                  "fasilitas"],
    "category_only": ["beach", "waterfall", "lake", "river", "forest", "mountain", "hill", "nature", "park"],
    "free_phrases": ["gratis", "free", "tanpa biaya", "tidak dipungut biaya", "free entry"],
    "non_attraction_words": ["sawah", "kebun pribadi", "tanah kosong", "simpang", "jalan", "kantor",
                             "terminal", "toko", "warung", "cafe", "kopi", "biro", "travel", "agen", "stasiun",
                             "properti pribadi", "hotel", "homestay", "villa", "penginapan"],
    "post_pattern": r"(?U)\bpos\s",
    "dock_words": ["dermaga", "port", "dock", "jetty"],
    "dock_categories": ["island", "beach"],
    "dock_pass_words": ["wisata", "pulau", "pantai"],
    "gate_words": ["gerbang", "gate"],
    "parking_words": ["parkiran", "tempat parkir"],
    "parking_pass_words": ["wisata", "pantai", "pulau", "curup", "air terjun", "taman"],
}

# Search text templates, {name} and {region} are filled per row.
RESEARCH_TEMPLATES = [
    ("entry_ticket", "{name} harga tiket masuk"),
    ("entry_ticket_new", "{name} tiket terbaru"),
    ("entry_ticket_tarif", "{name} tarif masuk"),
    ("parking", "{name} harga parkir"),
    ("ride", "{name} harga wahana"),
    ("package", "{name} paket wisata"),
    ("social_official", "{name} Instagram resmi"),
    ("social_fb", "{name} Facebook resmi"),
    ("gov_query", 'site:go.id "{name}" tiket'),
    ("insta_query", 'site:instagram.com "{name}" tiket'),
    ("fb_query", 'site:facebook.com "{name}" harga'),
    ("price_quote", '"{name}" "Rp"'),
]

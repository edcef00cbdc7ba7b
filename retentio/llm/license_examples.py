"""The labelled table of operator 5, and its templates. Licence sentences
are fixed values: the public wording of the licences' notices."""

EXAMPLES = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "This software is released under the MIT License, see LICENSE for details.",
        "Distributed under the MIT License. See the LICENSE file for more information.",
        "The MIT License (MIT)",
        "MIT License",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "Released under the Apache License, Version 2.0.",
        "This project is licensed under the Apache License, Version 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
        "Apache License Version 2.0, January 2004",
        "Apache License 2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of "
        "the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "Released under the GNU General Public License, version 3.",
        "This project is licensed under the GNU General Public License v3.0.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this "
        "program. If not, see https://www.gnu.org/licenses/.",
    ],
    "cc": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 3.0.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC BY-ND 4.0.",
        "Released under CC BY-NC 4.0.",
        "This work is licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 3.0 License.",
        "Creative Commons Attribution 4.0 International",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD License.",
        "This project is licensed under the BSD 2-Clause License.",
        "BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission.",
    ],
    "mpl": [
        "Licensed under the Mozilla Public License, v. 2.0.",
        "Released under the Mozilla Public License, version 2.0.",
        "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ],
    "unknown": [
        "This text is licensed under the terms of our own house agreement.",
        "Licensed for use by members of the society only.",
        "All rights reserved. No part of this work may be copied without written permission.",
        "Copyright by the author, all rights reserved.",
        "The licence of this package is found in the file of that name.",
        "This data set is released under a licence of its own, see the terms of use.",
        "Proprietary and confidential. Unlicensed copying of this file is forbidden.",
        "You may use this software under the licence that came with it.",
    ],
    "none": [
        "She had not expected an answer so soon, and read the letter twice.",
        "The river rose again in the night and by morning the lower road was closed.",
        "He lost his driving licence and had to take the bus to work.",
        "The general spoke to the public in the square.",
        "A new version of the play opened at the theatre in the city.",
        "The software of the machine was changed and the copies were sold.",
        "They were released from the hospital on the third day.",
        "The work is done and the house is under a new roof.",
        "It was a free concert and any person could come in.",
        "The notice on the door said that the shop was shut.",
        "The conditions on the road were bad and the bus came late.",
        "An apache helicopter flew over the mill at noon.",
        "The common law of the land is creative in its use of terms.",
        "Their attribution of the picture to the master was wrong.",
        "The foundation gave money to the school and the public library.",
        "The file was on the desk and the name on it was hers.",
        "The above is the list of those who came, the following of those who did not.",
        "We were permitted to go in, provided that we paid.",
        "Das Haus am Fluss war leer und die Tür stand offen.",
        "La maison était vide et la porte ouverte sur la rue.",
        "La casa estaba vacía y la puerta abierta a la calle.",
    ],
}
